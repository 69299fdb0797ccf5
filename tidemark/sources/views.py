"""Named views and the external output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import delete, swap


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def scan_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}")


def publish_output(
    df: DataFrame, path: str, columns: Sequence[str] = ("*",), partition_by: Sequence[str] = ()
) -> None:
    """Write chosen columns as parquet, partitioned if asked, replacing the path.

    The rows are written to a hidden folder beside ``path``, which then takes its
    place. A write that fails leaves the path as it was; ``df`` may read from it.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    beside = f"{parent}/_{name}-{uuid.uuid4().hex}"
    try:
        df.select(*columns).write.partitionBy(*partition_by).parquet(beside)
        swap(spark, beside, path)
    finally:
        delete(spark, beside)
