"""Choosing and scanning the newest day of a table partitioned by year/month/day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import partition_date, partition_predicate_text, workday_anchor

DAYS_BACK = 2  # fixed value: how far before the anchor a partition may lie


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """year, month, day of a catalog table's partitions, from the catalog alone."""
    spec = F.str_to_map("partition", F.lit("/"), F.lit("="))
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        *(spec[part].cast("int").alias(part) for part in ("year", "month", "day"))
    )


def recent_partitions(
    partitions: DataFrame, run_date: dt.date, days_back: int = DAYS_BACK, until: dt.date | None = None
) -> DataFrame:
    """Distinct year, month, day later than the anchor of ``run_date`` less ``days_back``.

    ``partitions`` is a listing or the table itself: the condition is on
    partition columns only, so older partitions are pruned. Later days than
    the run date qualify, unless ``until`` ends the range.
    """
    date = partition_date()
    recent = date > F.date_sub(workday_anchor(F.lit(run_date)), days_back)
    if until is not None:
        recent &= date <= F.lit(until)
    return partitions.where(recent).select("year", "month", "day").distinct()


def latest_partition(recent: DataFrame, run_date: dt.date) -> DataFrame:
    """One row: the newest date, or the anchor if there is none, and its predicate text."""
    anchor = workday_anchor(F.lit(run_date))
    return recent.agg(F.coalesce(F.max(partition_date()), anchor).alias("date_ref")).select(
        "date_ref", partition_predicate_text("date_ref").alias("predicate")
    )


def scan_partition(table: DataFrame, date: dt.date) -> DataFrame:
    """The rows of one day; the condition becomes a partition filter of the scan."""
    return table.where(
        (F.col("year") == date.year) & (F.col("month") == date.month) & (F.col("day") == date.day)
    )


def latest_partition_scan(
    table: DataFrame,
    run_date: dt.date,
    days_back: int = DAYS_BACK,
    until: dt.date | None = None,
    partitions: DataFrame | None = None,
) -> tuple[DataFrame, dt.date, str]:
    """Scan of the newest recent day, with that day and the predicate text.

    Without a listing in ``partitions``, the table's recent files are asked
    for their partition values.
    """
    recent = recent_partitions(table if partitions is None else partitions, run_date, days_back, until)
    newest = latest_partition(recent, run_date).first()
    return scan_partition(table, newest.date_ref), newest.date_ref, newest.predicate
