"""Joining a skewed table to one that has a single row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEWEST_HOT_ROWS = 10_000


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """The keys with at least ``hot_rows`` rows, one a row; no job runs for them here.

    By default a key is hot from half the rows of an average shuffle partition
    on (and ``FEWEST_HOT_ROWS``), so there are at most twice as many hot keys
    as shuffle partitions, whatever the table's size. Only the key column is
    read, and it is counted before the shuffle. Null is no key.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    if hot_rows is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        total = df.select(F.count("*")).scalar()
        least = F.greatest(F.lit(FEWEST_HOT_ROWS), total / (2 * partitions))
    else:
        least = F.lit(hot_rows)
    return counted.where(F.col("_rows") >= least).select(key)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot_rows: int | None = None,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, key, how)`` where ``right`` has one row per key.

    Rows of hot keys meet their partners, one a key, by broadcast and are not
    shuffled, nor are rows without a key, which meet none; all others join by
    shuffle. Adaptive skew handling does not cover this, as ``right`` usually ends
    in a window or aggregate on the same key and not in a plain shuffle. The hot
    keys are a part of the plan: they are counted when it runs, in ``left``, best a
    written table, or in ``counted_in``, a table with the same keys that is easier
    to read.
    """
    hot = F.broadcast(hot_keys(left if counted_in is None else counted_in, key, hot_rows))
    tagged = left.join(hot.withColumn("_hot", F.lit(True)), key, "left").select(*left.columns, "_hot")
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    partners = F.broadcast(right.join(hot, key, "left_semi"))
    return (
        tagged.where(apart)
        .drop("_hot")
        .join(partners, key, how)
        .unionByName(tagged.where(~apart).drop("_hot").join(right, key, how))
    )
