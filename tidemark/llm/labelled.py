"""A bounded sample of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_fold, share


def sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    per_class: int,
    most_bytes: int,
    folds: int = 3,
    held_out: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list[tuple[str, int]]:
    """(text, label) of up to ``per_class`` rows of label 0 and as many of label 1.

    Rows without id or label and those of the fold held out are never taken; of the
    others those whose md5 of the id comes first. Whole texts, but none above
    ``most_bytes``, so what the driver gets is bounded by the three parameters.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        ~is_fold(F.col("_id"), folds, held_out) & F.col("_label").isin(0, 1)
    )
    first = F.md5(F.col("_id").cast("string")), F.col("_id")
    seen = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    picked = [  # of each label three times as many as asked for go on, and 2 x per_class of these
        known.where((F.col("_label") == y) & (share(F.col("_id")) < 3 * per_class / seen.get(y, 1))).orderBy(*first).limit(2 * per_class)
        for y in (0, 1)
    ]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # at most 4 x per_class rows
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .join(few, "_id")
        .where(F.col("_text").isNotNull() & (F.octet_length("_text") <= most_bytes))
    )
    got = [
        rows.where(F.col("_label") == y).orderBy(*first, "_text").limit(per_class).select("_text", "_label") for y in (0, 1)
    ]
    return [(r["_text"], r["_label"]) for r in got[0].unionByName(got[1]).collect()]
