"""Joining a batch with the lookup cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import dedup_latest
from tidemark.operators.skew import lookup_join

#: The tags of rows with and without an answer.
SAVE, SKIPPED = "save", "skipped"


def latest_answers(cache: DataFrame) -> DataFrame:
    """One answer per id: that of the highest ``version``, within it the highest ``page``, both numbers.

    A table without these columns has one answer per id or says the version
    and page of none; then the greatest ``partition_ref`` counts. An answer
    may have a null uuid.
    """
    order = [c for c in ("version", "page") if c in cache.columns]
    rows = cache.select("uuid", "id", "partition_ref", *order)
    return dedup_latest(rows, ["id"], order or ["partition_ref"]).select("uuid", "id", "partition_ref")


def known_answers(ids: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct ids with the cache's latest answer to each; where it has none, both columns are null.

    The cache is bucketed by id: it stays where it is, whatever the number of
    ids, and only these are shuffled.
    """
    return ids.select("id").join(latest_answers(cache), "id", "left").select("uuid", "id", "partition_ref")


def _answers(cache: DataFrame, key: str) -> DataFrame:
    return latest_answers(cache).withColumnRenamed("id", key)


def enrich_tagged(
    batch: DataFrame, cache: DataFrame, key: str = "id", hot_rows: int | None = None
) -> DataFrame:
    """Add ``uuid`` and ``partition_ref`` of the latest answer, and ``state``: save or skipped."""
    return lookup_join(batch, _answers(cache, key), key, "left", hot_rows).select(
        *batch.columns,
        "uuid",
        "partition_ref",
        F.when(F.col("uuid").isNull(), SKIPPED).otherwise(SAVE).alias("state"),
    )


def enrich_matched(
    batch: DataFrame, cache: DataFrame, key: str = "id", hot_rows: int | None = None
) -> DataFrame:
    """The rows with an answer that has a uuid."""
    answered = _answers(cache, key).where(F.col("uuid").isNotNull())
    return lookup_join(batch, answered, key, "inner", hot_rows).select(*batch.columns, "uuid", "partition_ref")


def enrich_unmatched(
    batch: DataFrame, cache: DataFrame, key: str = "id", hot_rows: int | None = None
) -> DataFrame:
    """The rows without one."""
    answered = _answers(cache, key).where(F.col("uuid").isNotNull()).select(key)
    return lookup_join(batch, answered, key, "left_anti", hot_rows).select(*batch.columns)


def enrich_full_outer(batch: DataFrame, cache: DataFrame, key: str = "id") -> DataFrame:
    """Each batch row with each answer to its id, and cached answers to ids the batch lacks.

    A row without an answer, and an answer without a uuid, is ``skipped``, all
    else ``save``. Answers that are equal are one row that says in ``copies``
    how many they are. A full outer join as its left join plus the cache's own
    rows: Spark can split both where an id has very many rows.
    """
    answers = cache.groupBy(F.col("id").alias(key), "uuid", "partition_ref").agg(F.count("*").alias("copies"))
    met = batch.join(answers, key, "left")
    cache_only = answers.join(batch.select(key).distinct(), key, "left_anti")
    return met.unionByName(cache_only, allowMissingColumns=True).select(
        *batch.columns,
        "uuid",
        "partition_ref",
        F.when(F.col("uuid").isNull(), SKIPPED).otherwise(SAVE).alias("state"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def unmatched_sample(unmatched: DataFrame, size: int = 20, key: str = "id") -> DataFrame:
    """The first ``size`` unmatched ids, one per row, for a log line."""
    return unmatched.select(key).orderBy(key).limit(size)
