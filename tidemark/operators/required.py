"""Required columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not null."""
    return df.where(F.col(column).isNotNull())


def require_description(df: DataFrame, column: str = "description") -> DataFrame:
    return require(df, column)


def require_code(df: DataFrame, column: str = "code") -> DataFrame:
    return require(df, column)
