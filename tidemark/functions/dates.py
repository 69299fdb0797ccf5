"""Calendar expressions for choosing a partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def workday_anchor(day: str | Column) -> Column:
    """The day itself, or the Friday before it on a weekend."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def partition_date(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """Date of a year/month/day partition; the values may be text."""
    return F.make_date(*(F.col(c).cast("int") for c in (year, month, day)))


def partition_predicate_text(date: str | Column) -> Column:
    """``year=YYYY and month=MM and day=DD`` for the run report."""
    return F.date_format(date, "'year='yyyy' and month='MM' and day='dd")
