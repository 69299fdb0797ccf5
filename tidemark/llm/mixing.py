"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A source whose target is r times its size
(r at most ``most``) takes every document floor(r) times, the certain whole copies,
and one copy more of a sample. For that the documents of the source are ranked by
random odds divided by inclusion odds, u / (1 - u) over w * f / (1 - f), where f is
the fractional part of r and w a document's weight; the sample is the beginning of
that ranking whose words come nearest to what the target still lacks. Everything
is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_few, written

#: Bins of a source's ranking; a second time as many within the bin that holds the cut.
BINS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0 for the first by code point, nulls last; no sort in a single task."""
    order = F.col("source").isNull(), F.col("source")
    parts = written(
        sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ranges"
    )
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in sizes:  # one entry a partition
        starts.append((part, before))
        before += n
    if not starts:
        return parts.select("source", "source_size", F.lit(0).cast("long").alias("place"))
    start = F.create_map(*(F.lit(x).cast("long") for pair in starts for x in pair))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return parts.select(
        "source", "source_size", (inside - 1 + F.get(F.array(start), F.lit(0))[F.col("part").cast("long")]).alias("place")
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """A row for each source with ``target``, from (source, source_size).

    Sources in code point order, null last, get the weights in turn and share
    ``share`` times all sizes by weight; no target goes beyond ``most`` times its
    source's size, and what is too much is shared again by weight until none is above.
    Each round is one aggregate of one row.
    """
    array = F.array(*(F.lit(float(w)) for w in weights))
    table = written(
        _ranked(sizes).select(
            "source",
            "source_size",
            F.get(array, (F.col("place") % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * float(most)).alias("cap"),
        ),
        "mix-sources",
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    rate, capped = 0.0, -1
    while True:
        above = F.col("cap") <= F.col("weight") * rate
        row = table.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped, rate = row["n"], (total - row["taken"]) / row["weight"]
    target = F.col("cap") if not row["weight"] else F.least("cap", F.col("weight") * rate)
    return table.select("source", "source_size", target.alias("target"))


def uniform(id_col: Column, text: Column, seed: int) -> Column:
    """A number above 0 and below 1 from 52 bits of md5 of seed and id, or of the text where there is no id."""
    key = F.coalesce(id_col.cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / float(2**52)


def _before(rows: DataFrame, bins: Sequence[str], size: Column) -> DataFrame:
    """For each source and last of ``bins``, the words ranked before that bin and up to its end."""
    *group, last = bins
    sums = rows.groupBy("_s", *bins).agg(F.sum(size).alias("_in"))
    window = Window.partitionBy("_s", *group).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("_ahead", F.coalesce(F.sum("_in").over(window), F.lit(0)))


def _copies(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``rows`` (_row, _source, _size, _u, _id), written before, with source_size, target and copies."""
    rows = rows.withColumn("_s", F.coalesce(F.concat(F.lit("s"), F.col("_source")), F.lit("null")))
    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    ratio = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size"))
    whole = F.floor(ratio)
    plan = written(
        targets(sizes, weights, share, most).select(
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("_s"),
            "source_size",
            "target",
            whole.alias("whole"),
            (ratio - whole).alias("f"),
            (F.col("target") - whole * F.col("source_size")).alias("lack"),
        ),
        "mix-plan",
    )
    rows = join_few(rows, plan, ["_s"])
    odds = F.col("f") * (1 + F.log2(1 + F.col("_size")) / 16)
    key = F.col("_u") * (1 - F.col("f")) / ((1 - F.col("_u")) * odds)  # random odds over inclusion odds
    rows = rows.withColumn("_k", F.when(F.col("f") > 0, key / (1 + key)))
    place = F.least(F.col("_k") * BINS, F.lit(BINS - 1e-9))
    rows = rows.withColumn("_b", F.floor(place).cast("int")).withColumn(
        "_c", F.floor((place - F.floor(place)) * BINS).cast("int")
    )
    open_rows = rows.drop("_row").where((F.col("f") > 0) & (F.col("_size") > 0))
    of_source = Window.partitionBy("_s")
    coarse = written(
        join_few(_before(open_rows, ["_b"], F.col("_size")), plan.select("_s", "lack"), ["_s"])
        .where(F.col("_ahead") <= F.col("lack"))
        .withColumn("_last", F.max("_b").over(of_source))
        .where(F.col("_b") == F.col("_last"))
        .select("_s", "_b", F.col("_ahead").alias("_ahead_b")),
        "mix-bins",
    )
    near = join_few(open_rows.select("_s", "_b", "_c", "_size", "lack"), coarse, ["_s", "_b"])
    sums = near.groupBy("_s", "_b", "_ahead_b", "lack", "_c").agg(F.sum("_size").alias("_in"))
    upto = Window.partitionBy("_s").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    cuts = written(
        sums.withColumn("_ahead", F.col("_ahead_b") + F.coalesce(F.sum("_in").over(upto), F.lit(0)))
        .where(F.col("_ahead") <= F.col("lack"))
        .withColumn("_last", F.max("_c").over(of_source))
        .where(F.col("_c") == F.col("_last"))
        .select("_s", F.col("_b").alias("_cut_b"), F.col("_c").alias("_cut_c"), "_ahead"),
        "mix-cuts",
    )
    rows = join_few(rows, cuts, ["_s"], "left")
    side = F.when(F.col("_b") != F.col("_cut_b"), F.signum(F.col("_b") - F.col("_cut_b"))).otherwise(
        F.signum(F.col("_c") - F.col("_cut_c"))
    )
    rows = rows.withColumn("_side", F.when(F.col("_size") > 0, F.coalesce(side, F.lit(1.0))).otherwise(F.lit(1.0)))
    # only the rows of the bin that holds the cut, a few in 16 millions of a source, are ranked one by one
    order = Window.partitionBy("_s").orderBy("_k", "_size", "_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.where(F.col("_side") == 0).withColumn("_upto", F.sum("_size").over(order) + F.col("_ahead"))
    edge = edge.withColumn("_extra", (F.col("_upto") - F.col("_size") / 2 <= F.col("lack")).cast("long"))
    rest = rows.where(F.col("_side") != 0).withColumn("_extra", (F.col("_side") < 0).cast("long"))
    out = ["_row", "_size", "source_size", "target", (F.col("whole") + F.col("_extra")).alias("_copies")]
    return edge.select(*out).unionByName(rest.select(*out))


def _rows(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return written(
        docs.select(
            row.alias("_row"),
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_source"),
            n_words(F.col(text_col)).alias("_size"),
            uniform(F.col(id_col), F.col(text_col), seed).alias("_u"),
        ),
        "mix-rows",
    )


def with_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 6,
) -> DataFrame:
    """(id, size, source_size, target, copies) for each row of ``docs``.

    Null texts and texts without a word have size 0 and are taken as often as is
    certain, which adds no words. Rows without a source form a source of their own,
    the last. Equal ids get equal random numbers; ties in the ranking are broken by
    size, and rows alike in both count as one after the other. The empty table gives
    an empty result. Longer documents have higher odds of the further copy: their
    weight is 1 + log2(1 + size) / 16. Columns of ``docs`` other than the three
    named are not looked at.
    """
    rows = _rows(docs, F.struct(F.col(id_col).alias("id")), id_col, text_col, source_col, seed)
    got = _copies(rows, weights, share, most)
    return got.select("_row.id", F.col("_size").alias("size"), "source_size", "target", F.col("_copies").alias("copies"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 6,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns as they came.

    The cases are those of :func:`with_copies`.
    """
    rows = _rows(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)), id_col, text_col, source_col, seed)
    taken = _copies(rows, weights, share, most).where("_copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
