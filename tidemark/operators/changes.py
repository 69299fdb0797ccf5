"""Comparing a batch with the state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import row_fingerprint
from tidemark.operators.skew import lookup_join

#: The tags of a comparison.
NEW, CHANGED, REPEATED = "new", "changed", "repeated"


def change_detect(
    batch: DataFrame,
    state: DataFrame,
    key_cols: Sequence[str],
    fingerprint_cols: Sequence[str],
    null_token: str | None = None,
) -> DataFrame:
    """Add the fingerprint ``sha2`` and ``change``: new, changed or repeated.

    Both sides have one row per key. A key with a null in it equals no key
    of the state, so its row is always new.
    """
    current = state.select(*key_cols, F.col("sha2").alias("_old_sha2"))
    return (
        batch.withColumn("sha2", row_fingerprint(*fingerprint_cols, null_token=null_token))
        .join(current, list(key_cols), "left")
        .withColumn(
            "change",
            F.when(F.col("_old_sha2").isNull(), NEW)
            .when(F.col("sha2") != F.col("_old_sha2"), CHANGED)
            .otherwise(REPEATED),
        )
        .select(*batch.columns, "sha2", "change")
    )


def rows_to_save(tagged: DataFrame) -> DataFrame:
    """The new and changed rows of :func:`change_detect`."""
    return tagged.where(F.col("change") != REPEATED).drop("change")


def change_detect_by_code(
    batch: DataFrame,
    state: DataFrame,
    fingerprint_cols: Sequence[str],
    code: str = "code",
    hot_rows: int | None = None,
) -> DataFrame:
    """The comparison on ``code`` alone, several ids sharing a code.

    Each batch row meets each state row of its code: ``save`` where the
    fingerprints differ, ``skip`` where they agree, ``save`` once if the code
    is unknown. These pairs are counted, not made: ``copies`` says how often
    the row occurs with that ``state``.
    """
    per_code = state.groupBy(code).agg(F.count("*").alias("_of_code"))
    both = F.concat("sha2", code)  # a fingerprint is 64 signs, so this tells both apart
    per_fingerprint = state.groupBy(both.alias("_both")).agg(F.count("*").alias("_equal"))
    new = batch.withColumn("sha2", row_fingerprint(*fingerprint_cols)).withColumn("_both", both)
    counted = lookup_join(new, per_code, code, "left", hot_rows, counted_in=batch)
    counted = lookup_join(counted, per_fingerprint, "_both", "left", hot_rows, counted_in=new)
    equal = F.coalesce("_equal", F.lit(0))
    saved = F.when(F.col("_of_code").isNull(), 1).otherwise(F.col("_of_code") - equal)
    outcomes = F.array(
        F.struct(F.lit("save").alias("state"), saved.cast("long").alias("copies")),
        F.struct(F.lit("skip").alias("state"), equal.cast("long").alias("copies")),
    )
    return counted.select(*batch.columns, "sha2", F.inline(outcomes)).where(F.col("copies") > 0)
