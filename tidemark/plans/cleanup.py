"""The cleanup step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_latest
from tidemark.operators.required import require_code, require_description


def cleanup(
    raw: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    description: str = "description",
    code: str = "code",
) -> DataFrame:
    """Latest row per key, then description and code required.

    In this order: a key whose latest row lacks a description is dropped even
    if an older row has one.
    """
    return (
        raw.transform(dedup_latest, key_cols, order_cols)
        .transform(require_description, description)
        .transform(require_code, code)
    )


def is_valid(description: str = "description", code: str = "code") -> Column:
    """True for those of the latest rows the cleanup keeps."""
    return F.col(description).isNotNull() & F.col(code).isNotNull()


def latest_row_counters(description: str = "description", code: str = "code") -> list[Column]:
    """The cleanup counters that can be read off the latest rows."""
    described = F.col(description).isNotNull()
    valid = is_valid(description, code)
    return [
        F.count("*").alias("de_duplicated_count"),
        F.count_if(~described).alias("no_description"),
        F.count_if(described).alias("description_count"),
        F.count_if(described & ~valid).alias("no_code_count"),
        F.count_if(valid).alias("code_count"),
        F.count_if(valid).alias("valid_rows"),
    ]


def cleanup_report(
    raw: DataFrame,
    key_cols: Sequence[str],
    order_cols: Sequence[str],
    description: str = "description",
    code: str = "code",
) -> DataFrame:
    """All cleanup counters in one row, by one query.

    The raw rows are counted on their own, without reading a column.
    """
    counted = raw.agg(F.count("*").alias("raw_count"))
    latest = dedup_latest(raw, key_cols, order_cols).agg(*latest_row_counters(description, code))
    both = counted.unionByName(latest, allowMissingColumns=True)
    return (
        both.agg(*(F.max(c).alias(c) for c in both.columns))
        .withColumn("duplicated_count", F.col("raw_count") - F.col("de_duplicated_count"))
        .select("raw_count", "duplicated_count", *latest.columns)
    )
