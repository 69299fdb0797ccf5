"""Exact top-k inner products with vector-approximation files.

Every component is quantised to one of 256 cells. A scan of the cells, a byte a
component, gives bounds on each score, and of each query only the rows stay that can
be among its k best. Exact vectors are then read in the order of the best possible
score: first those of the most promising rows, then of those that the k-th exact score
so far does not rule out. Queries are taken in blocks of a bounded size, each of which
meets all cells; the exact vectors are read twice, whatever the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import lean, tidied, written

#: Queries in a block, which goes to every task, and the most components all of a block may have.
BLOCK, BLOCK_COMPONENTS = 8192, 1 << 22
CELLS = 256
#: Components from which on a vector has no cells, as these would be too wide for all others.
WIDE = 2.0**26
#: Rows read first of each query, in multiples of k.
FIRST = 2

_NEAR = "q long, row long, upper double, lower double"


def _whole(vector: Column) -> Column:
    """floor(1024 * x) of each component, a whole number as double; null where a component is null or not finite."""
    parts = F.transform(vector, lambda x: x.cast("double") * 1024)
    fine = F.forall(parts, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(fine & (F.size(vector) > 0), F.transform(parts, _floor))


def _floor(x: Column) -> Column:
    """The floor as a double; from 2 ** 53 on every double is whole."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


@dataclass(frozen=True)
class Index:
    """``rows`` (row, id, dim, vector) of all usable rows, and ``cells`` (row, dim, cells) of those without wide components.

    A cell holds ``width`` values from ``lo`` on.
    """

    rows: DataFrame
    cells: DataFrame
    lo: float
    width: float


def _is_wide() -> Column:
    return F.exists("vector", lambda x: F.abs(x) >= WIDE)


def index(vectors: DataFrame, id_col: str, vector_col: str) -> Index:
    """The vectors and their cells, written to the shared folder. Rows with a null id take part."""
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), _whole(F.col(vector_col)).alias("vector")).where("vector is not null")
    rows = written(usable.select(F.monotonically_increasing_id().alias("row"), "id", F.size("vector").alias("dim"), "vector"), "va-vectors")
    usual = rows.where(~_is_wide())
    ends = usual.agg(F.min(F.array_min("vector")).alias("lo"), F.max(F.array_max("vector")).alias("hi")).first()
    lo, hi = ends["lo"] or 0.0, ends["hi"] or 0.0
    width = (hi - lo) // CELLS + 1

    @F.arrow_udf("binary")
    def cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = np.asarray(batch.flatten())
            ends = np.concatenate([[0], np.cumsum(np.asarray(batch.value_lengths()))])
            data = ((flat - lo) // width).astype(np.uint8).tobytes()
            yield pa.array([data[a:b] for a, b in zip(ends, ends[1:])], pa.binary())

    return Index(rows, written(usual.select("row", "dim", cells("vector").alias("cells")), "va-cells"), lo, width)


class Near:
    """Of each query the rows met so far that can be among its k best, with the bounds of their scores."""

    def __init__(self, own: np.ndarray, queries: np.ndarray, k: int):
        self.own, self.queries, self.k = own, queries, k
        self.size = np.abs(queries).sum(axis=1)
        none = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        self.found = [none] * len(own)

    def _add(self, first: int, rows: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        _, mine, at = np.intersect1d(self.own[first : first + len(upper)], rows, return_indices=True)
        upper[mine, at] = lower[mine, at] = -np.inf  # a query's own row is no candidate
        for j in range(len(upper)):
            old = self.found[first + j]
            sure = np.concatenate([lower[j], old[2]])
            bar = np.partition(sure, len(sure) - self.k)[len(sure) - self.k] if len(sure) >= self.k else -np.inf
            new = np.flatnonzero((upper[j] >= bar) & (upper[j] > -np.inf))
            stay = old[1] >= bar
            parts = (rows[new], upper[j][new], lower[j][new])
            self.found[first + j] = tuple(np.concatenate([x[stay], y]) for x, y in zip(old, parts))

    def add_cells(self, rows: np.ndarray, cells: np.ndarray, lo: float, width: float) -> None:
        edge = cells.astype(np.float64) * width + lo
        most = np.abs(edge).max(initial=1.0) + width
        for first in range(0, len(self.own), 256):
            block = self.queries[first : first + 256]
            base = block @ edge.T
            slack = 1e-9 * self.size[first : first + 256] * most + 1
            upper = base + ((width - 1) * np.maximum(block, 0).sum(axis=1) + slack)[:, None]
            lower = base + ((width - 1) * np.minimum(block, 0).sum(axis=1) - slack)[:, None]
            self._add(first, rows, upper, lower)

    def add_vectors(self, rows: np.ndarray, vectors: np.ndarray) -> None:
        """Rows without cells: the bounds are those of the rounding."""
        for first in range(0, len(self.own), 256):
            block = self.queries[first : first + 256]
            with np.errstate(over="ignore", invalid="ignore"):
                base, size = block @ vectors.T, np.abs(block) @ np.abs(vectors).T
                slack = 1e-9 * size + 1
                upper, lower = base + slack, base - slack
            open_ended = ~np.isfinite(upper) | ~np.isfinite(lower)
            upper[open_ended], lower[open_ended] = np.inf, -np.inf
            self._add(first, rows, upper, lower)

    def batch(self) -> pa.RecordBatch | None:
        sizes = [len(rows) for rows, _, _ in self.found]
        if not sum(sizes):
            return None
        columns = [np.repeat(self.own, sizes), *(np.concatenate(x) for x in zip(*self.found))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q", "row", "upper", "lower"])


def _near(table: Index, own: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(q, row, upper, lower) of what each task finds for a block of queries (row numbers and vectors)."""
    dim, lo, width = queries.shape[1], table.lo, table.width
    sent = table.rows.sparkSession.sparkContext.broadcast((own, queries))
    step = max(1, (1 << 20) // dim)

    @lean
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Near(*sent.value, k)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                data = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, dim)
                near.add_cells(part.column(0).to_numpy(), data, lo, width)
        if (found := near.batch()) is not None:
            yield found

    @lean
    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Near(*sent.value, k)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                near.add_vectors(part.column(0).to_numpy(), np.asarray(part.column(1).flatten()).reshape(part.num_rows, dim))
        if (found := near.batch()) is not None:
            yield found

    by_cells = table.cells.where(F.col("dim") == dim).select("row", "cells").mapInArrow(cells, _NEAR)
    others = table.rows.where((F.col("dim") == dim) & _is_wide()).select("row", "vector").mapInArrow(wide, _NEAR)
    return written(by_cells.unionByName(others), "va-near")


def _dot(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Inner products of the rows of ``x`` with ``y``, of whole numbers, exactly."""
    if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * len(y) < 2.0**62:
        return (x.astype(np.int64) @ y.astype(np.int64)).tolist()
    whole = [int(v) for v in y]
    return [sum(int(v) * w for v, w in zip(row, whole)) for row in x]


def _scored(pairs: DataFrame, vectors: DataFrame, own: np.ndarray, queries: np.ndarray) -> DataFrame:
    """(q, row, id, score) of ``pairs`` (q, row) of one block of queries, with the exact ``vectors`` (row, id, vector)."""
    sent = pairs.sparkSession.sparkContext.broadcast((own, queries))

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = sent.value
        order = np.argsort(own)
        for batch in batches:
            out = {"q": [], "row": [], "id": [], "score": []}
            for r in batch.to_pylist():
                at = order[np.searchsorted(own, r["qs"], sorter=order)]
                scores = _dot(queries[at], np.array(r["vector"]))
                wrong = [s for s in scores if not -(2**63) <= s < 2**63]
                if wrong:
                    raise ValueError(f"the score {wrong[0]} of row {r['id']} does not fit 64 bits")
                out["q"] += r["qs"]
                out["row"] += [r["row"]] * len(at)
                out["id"] += [r["id"]] * len(at)
                out["score"] += scores
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.values()], list(out))

    by_row = pairs.groupBy("row").agg(F.collect_list("q").alias("qs"))  # at most a block's queries each
    return vectors.join(by_row, "row").select("row", "id", "vector", "qs").mapInArrow(score, "q long, row long, id long, score long")


def _read(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The exact vectors (row, id, vector) of all rows in ``pairs``, written: one scan."""
    wanted = written(pairs.select("row").distinct(), "va-wanted")
    wanted = F.broadcast(wanted) if wanted.limit(1_000_001).count() <= 1_000_000 else wanted  # 8 bytes each
    return written(rows.select("row", "id", "vector").join(wanted, "row"), "va-read")


def _query_blocks(table: Index, every: int) -> tuple[DataFrame, list[Row]]:
    """The queries (row, id, dim, vector, part), written, and the (dim, part) of their blocks, an entry for some thousand queries."""
    place = F.row_number().over(Window.partitionBy(F.xxhash64("row") % 1024, "dim").orderBy("row"))
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_COMPONENTS) / F.col("dim")))) / 1024
    asked = table.rows.where(F.col("id") % every == 0).withColumn("part", F.floor(place / rows))
    asked = written(asked, "va-queries")
    return asked, asked.select("dim", "part").distinct().orderBy("dim", "part").collect()


@tidied
def top_k(
    vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by ``every``.

    Score: inner product of the components' floor(1024 * x); ties go to the smaller id.
    A query's own row is no candidate, other rows of the same id are; a query that
    occurs n times has n such lists. Rows whose vector is null, empty, or has a null
    or non-finite component take no part; all others do, whatever their size, but a
    score that may be among the k best and does not fit 64 bits is an error. Rows of
    another length than the query are not compared with it; rows with a null id are
    candidates, after all others of the same score. The empty table gives an empty
    result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    table = index(vectors, id_col, vector_col)
    asked, parts = _query_blocks(table, every)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def block(part: Row) -> tuple[np.ndarray, np.ndarray]:
        rows = asked.where((F.col("dim") == part["dim"]) & (F.col("part") == part["part"])).orderBy("row").collect()
        return np.array([r["row"] for r in rows], np.int64), np.array([r["vector"] for r in rows]).reshape(len(rows), part["dim"])

    near = None
    for part in parts:
        found = _near(table, *block(part), k)
        near = found if near is None else near.unionByName(found)
    # over all tasks: what the k best lower bounds of a query rule out goes
    best = near.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))).where(F.col("nth") == k)
    near = near.join(best.select("q", F.col("lower").alias("bar")), "q", "left").where("bar is null or upper >= bar")
    order = Window.partitionBy("q").orderBy(F.desc("upper"), "row")
    by_query = asked.select(F.col("row").alias("q"), F.col("id").alias("query_id"), "dim", "part")
    near = near.withColumn("nth", F.row_number().over(order)).select("q", "row", "upper", "nth")
    near = written(near.join(by_query, "q"), "va-order")

    def exact(pairs: DataFrame) -> DataFrame:
        read, out = _read(table.rows, pairs), None
        for part in parts:
            own = pairs.where((F.col("dim") == part["dim"]) & (F.col("part") == part["part"])).select("q", "row")
            scored = _scored(own, read, *block(part))
            out = scored if out is None else out.unionByName(scored)
        return written(out, "va-scores")

    first = exact(near.where(F.col("nth") <= FIRST * k))
    kth = first.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("nth") == k)
    rest = near.where(F.col("nth") > FIRST * k).join(kth.select("q", F.col("score").alias("sure")), "q", "left")
    rest = exact(rest.where("sure is null or upper >= sure"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row"))
    done = first.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)
    return done.join(by_query.select("q", "query_id"), "q").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
