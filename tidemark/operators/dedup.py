"""Latest row per key, and the rows it displaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(value: Column, kind: T.DataType) -> Column:
    """The value in a form that has an order and is the same for equal values.

    Maps become sorted lists of their entries, variants their JSON text, also inside
    arrays, structs and maps; all else stays as it is.
    """
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    if isinstance(kind, T.ArrayType) and not _has_order(kind):
        return F.transform(value, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.StructType) and not _has_order(kind):
        parts = F.struct(*(canonical(value[f.name], f.dataType).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), parts)
    if isinstance(kind, T.MapType):
        entry = lambda x: F.struct(x["key"].alias("key"), canonical(x["value"], kind.valueType).alias("value"))
        return F.sort_array(F.transform(F.map_entries(value), entry))
    return value


def _has_order(kind: T.DataType) -> bool:
    return not any(t in kind.simpleString() for t in ("map<", "variant"))


def _newest_first(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> list:
    """Descending order on ``order_cols``, ties broken by every other column.

    Without the tie-break a recomputed task could pick another row. Columns whose
    type has no order (maps, variants) come last, in their canonical form.
    """
    rest = [f for f in df.schema.fields if f.name not in key_cols and f.name not in order_cols]
    rest.sort(key=lambda f: not _has_order(f.dataType))
    ties = (canonical(F.col(f"`{f.name}`"), f.dataType) for f in rest)
    return [c.desc_nulls_last() for c in (*(F.col(c) for c in order_cols), *ties)]


def dedup_latest(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_cols``, nulls last.

    Null keys form a group of their own. The rank filter is pushed to both
    sides of the shuffle as a window group limit, so a key sends one row per
    map task however many rows it has.
    """
    newest = Window.partitionBy(*key_cols).orderBy(*_newest_first(df, key_cols, order_cols))
    return (
        df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
    )


def dedup_discarded(
    df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], chunk: int = 100_000
) -> DataFrame:
    """The rows :func:`dedup_latest` drops, exact copies included.

    A rank above 1 would need every row of a key in one task. Instead whole
    rows are counted, the kept ones as -1, and what is left is repeated: the
    shuffle is on the whole row, copies are summed before it, and a row with
    more than ``chunk`` copies is repeated by several tasks.
    """
    columns = df.columns
    kept = dedup_latest(df, key_cols, order_cols)
    left_over = (
        df.withColumn("_n", F.lit(1))
        .unionByName(kept.withColumn("_n", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .where(F.col("_n") > 0)
    )
    few = left_over.where(F.col("_n") <= chunk)
    # A stated partition number, since adaptive execution would merge these
    # few and small rows into one task again.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        left_over.where(F.col("_n") > chunk)
        .withColumn("_start", F.explode(F.expr(f"sequence(0L, _n - 1, {chunk}L)")))
        .withColumn("_n", F.least(F.col("_n") - F.col("_start"), F.lit(chunk)))
        .drop("_start")
        .repartition(tasks)
    )
    return (
        few.unionByName(many)
        .withColumn("_copy", F.explode(F.expr("sequence(1L, _n)")))
        .select(*columns)
    )
