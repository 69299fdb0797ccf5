"""What the operators of this package share: names, folds, written tables, text blocks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import delete
from tidemark.sources.shared import new_folder

from .word_hashes import forget

#: A word is a run of bytes other than these.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Session settings and Spark's values.
ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
BYTES_A_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ready(spark: SparkSession, rows: str = "1000", size: str = "8m") -> None:
    """Lets Python workers import this package also where only the driver's path has it.

    That is for a session on one machine; on a cluster the package is installed or
    sent along with ``--py-files``. Also makes the session's Arrow batches small, of so
    many ``rows`` and about so many bytes (``size``), where they are as Spark has them, as
    rows hold whole texts or sets.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    for (key, usual), small in ((ROWS_A_BATCH, rows), (BYTES_A_BATCH, size)):
        if spark.conf.get(key) == usual:
            spark.conf.set(key, small)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or with underscores before it while ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(id_col.cast("string")) % n


def is_fold(id_col: Column, n: int, value: int) -> Column:
    """Whether a row is in that fold. A row without an id counts as in it, so it is never learnt from."""
    return F.coalesce(fold(id_col, n) == value, F.lit(True))


def share(id_col: Column) -> Column:
    """A number from 0 to 1 in the order of md5 of the id as text."""
    return F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("double") / float(2**32)


def most_common(counts: DataFrame, most: int) -> pa.Table:
    """The rows (h, c) of a written table with the highest ``c``, at most ``most`` of them, for the driver.

    All from some count on: a histogram by powers of 2 ** (1 / 8) tells which, so no
    task sends rows that are not among them.
    """
    step = F.floor(F.log2("c") * 8)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
        total += r["n"]
        if total > most:
            break
        least = r["step"]
    return counts.where(F.lit(False) if least is None else step >= least).select("h", "c").toArrow()


#: Folders that the operator at work has written to, if it deletes them at its end.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder, with Spark's ``options``, and read again: later steps survive lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """At the end all that was written within is deleted, also where it fails."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete(spark, path)


def tidied(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator`` with its result written, and all that it wrote on the way deleted, also where it fails."""

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **named) -> DataFrame:
        made: list[str] = []
        token = _MADE.set(made)
        try:
            result = operator(df, *args, **named)
            _MADE.reset(token)
            token = None
            return written(result, operator.__name__.replace("_", "-"))
        finally:
            if token is not None:
                _MADE.reset(token)
            for path in made:
                delete(df.sparkSession, path)

    return run


def words(text: Column) -> Column:
    """The words of a text in order; none for a text of white space only."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{WHITE}+"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, also where ``use`` loops over it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def join_few(rows: DataFrame, few: DataFrame, on: list[str], how: str = "inner", most: int = 100_000, salts: int = 64) -> DataFrame:
    """``rows`` joined with ``few``, a written table with a row a key, where one key may hold a third of the rows.

    ``few`` is counted: up to ``most`` rows it is broadcast, beyond that it is copied
    ``salts`` times and the rows are dealt over the copies.
    """
    if few.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(few), on, how)
    salt = free_name(rows, "_salt")
    dealt = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = F.floor(F.rand(7) * salts).cast("int")
    return rows.withColumn(salt, own).join(dealt, [*on, salt], how).drop(salt)


class Recent(dict):
    """What ``make`` gives for a key, remembered for short keys: the last ``most`` ones and up to as many before."""

    def __init__(self, make: Callable, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.before = make, most, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


def lean(function: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``function``, a generator run by a Python worker, which hands unused memory back to the system at its end.

    Workers are kept for later tasks; without this an idle one goes on holding what it needed most.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        forget()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
        if trim is not None:
            trim(0)

    return run


def few_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` bytes of the texts in ``column``; one row at least."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins and ends; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts in blocks of about ``most`` bytes: first, last + 1, bytes, offsets.

    A text is never cut: one above ``most`` is a block of its own.
    """
    data, offsets = text_bytes(texts)
    first, n = 0, len(texts)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        own = offsets[first : last + 1]
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last
