"""Merging delivered rows into the state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import lookup_join


def state_upsert(state: DataFrame, batch: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The state with the batch's fingerprints; keys the batch lacks stay.

    Both sides have one row per key.
    """
    keys = list(key_cols)
    current = state.select(*keys, F.col("sha2").alias("_old_sha2"))
    new = batch.select(*keys, F.col("sha2").alias("_new_sha2"))
    return current.join(new, keys, "full_outer").select(
        *keys, F.coalesce("_new_sha2", "_old_sha2").alias("sha2")
    )


def state_upsert_by_id(
    state: DataFrame, batch: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """The merge on ``id`` alone, several codes sharing an id.

    Each batch row meets each state row of its id and replaces it, so it
    occurs once per state row; ``copies`` says how often instead of making
    the pairs. The batch must have passed the cleanup: no null code.
    """
    key, columns = "id", ["id", "code", "sha2"]
    per_id = state.groupBy(key).agg(F.count("*").alias("_of_id"))
    from_batch = lookup_join(batch.select(*columns), per_id, key, "left", hot_rows).select(
        *columns, F.coalesce("_of_id", F.lit(1)).cast("long").alias("copies")
    )
    in_batch = batch.select(key).where(F.col(key).isNotNull()).distinct()
    from_state = lookup_join(state.select(*columns), in_batch, key, "left_anti", hot_rows).select(
        *columns, F.lit(1).cast("long").alias("copies")
    )
    return from_batch.unionByName(from_state)
