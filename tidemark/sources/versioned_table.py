"""A bucketed parquet table to which runs add rows, one commit each."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import delete, names, publish_once, read_text
from tidemark.sources.shared import read_if_there

ROWS_PER_BUCKET = 1_000_000
MOST_WRITES = 16
KEPT_GENERATIONS = 2

_COMMITS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("writes", T.ArrayType(T.StringType())),
        T.StructField("base_rows", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def buckets_for(rows: int) -> int:
    """Buckets for so many rows: a power of two, of at most ``ROWS_PER_BUCKET`` rows each on average."""
    return 1 << (max(0, rows - 1) // ROWS_PER_BUCKET).bit_length()


@dataclass(frozen=True)
class VersionedTable:
    """Rows below ``path``, bucketed by ``key_cols``, each with the version that wrote it.

    Each write has a folder, a partition of the bucketed table. It counts once an
    entry in ``commits`` names it; a commit's list prunes all other folders. Entries
    are files named by version that appear in one step and are never replaced, so of
    two runs that began from one version exactly one commits. When the added rows
    outnumber the base, after ``MOST_WRITES`` commits, or when a write would fill the
    buckets more than four times over, the next commit rewrites all into a new
    generation, with buckets by the number of rows (as many as
    ``spark.sql.sources.bucketing.maxBuckets`` allows, unless ``buckets`` sets them).
    A run of k rows so writes k rows, and its share of a rewrite. Joins on the keys do
    not shuffle the table. The files of the ``KEPT_GENERATIONS`` newest generations
    stay, so that a reader may go on while one rewrite takes place.
    """

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    key_cols: tuple[str, ...]
    buckets: int | None = None
    newest_only: bool = False

    def _log(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/commits", _COMMITS, "json")

    def commits(self) -> list[Row]:
        """The commit log, one short row per run, oldest first."""
        return self._log().orderBy("version").collect()

    def latest_commit(self) -> Row | None:
        entries = names(self.spark, f"{self.path}/commits")
        return Row(**json.loads(read_text(self.spark, f"{self.path}/commits/{entries[-1]}"))) if entries else None

    def is_committed(self, run_id: str) -> bool:
        return not self._log().where(F.col("run_id") == run_id).isEmpty()

    def rows(self, commit: Row | None = None) -> DataFrame:
        """All committed rows with their ``version``; the files of other writes are not looked at."""
        commit = commit or self.latest_commit()
        if commit is None:
            return self.spark.createDataFrame([], self._schema())
        name = self._declare(commit.generation, commit.buckets)
        if commit.writes:
            parts = " ".join(f"PARTITION (`_write` = '{write}')" for write in commit.writes)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return self.spark.table(name).where(F.col("_write").isin(list(commit.writes))).drop("_write")

    def newest(self, commit: Row | None = None) -> DataFrame:
        """The newest row of each key; where all come from one write, as they are."""
        commit = commit or self.latest_commit()
        rows = self.rows(commit)
        if commit is not None and (len(commit.writes) > 1 or not self.newest_only):
            last = Window.partitionBy(*self.key_cols).orderBy(F.desc("version"), *(F.desc(c) for c in self.columns))
            rows = rows.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") == 1).drop("_rank")
        return rows

    def append(self, rows: DataFrame, run_id: str, about: int | None = None) -> int:
        """Add ``rows`` and commit them; their number is counted as they are written.

        The buckets are sized by ``about`` how many rows there are; where that is not
        given, the rows are staged beside the table to count them.
        """
        rows = rows.select(*self.columns)
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        try:
            if about is None and self.buckets is None:
                counted = Observation()
                rows.observe(counted, F.count("*").alias("rows")).write.parquet(staged)
                rows, about = self.spark.read.schema(rows.schema).parquet(staged), counted.get["rows"]
            return self._added(rows, run_id, about or 0)
        finally:
            delete(self.spark, staged)

    def _added(self, rows: DataFrame, run_id: str, about: int) -> int:
        latest = self.latest_commit()
        version = latest.version + 1 if latest else 0
        outgrown = latest is not None and self._outgrown(latest, about)
        if outgrown:
            latest = self._rewritten(latest, about)
        generation = latest.generation if latest else uuid.uuid4().hex
        buckets = latest.buckets if latest else self._buckets(about)
        write = uuid.uuid4().hex
        added = self._write(rows.withColumn("version", F.lit(version).cast("long")), generation, buckets, write)
        if latest is None:
            writes, base, total = [write] if added else [], added, added
        else:
            writes = [*latest.writes, write] if added else list(latest.writes)
            base, total = latest.base_rows, latest.rows + added
        self._commit(version, run_id, generation, buckets, writes, base, total)
        if outgrown:
            self._tidy()
        return version

    def _buckets(self, rows: int) -> int:
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        return self.buckets or min(most, buckets_for(rows))

    def _outgrown(self, latest: Row, about: int) -> bool:
        if len(latest.writes) >= MOST_WRITES or latest.rows > 2 * latest.base_rows:
            return True
        return self.buckets is None and self._buckets(latest.rows + about) > 4 * latest.buckets

    def _rewritten(self, latest: Row, about: int) -> Row:
        """The rows that are read, in a generation of their own with room for more; not committed yet."""
        rows = self.newest(latest) if self.newest_only else self.rows(latest)
        count = rows.count() if self.newest_only else latest.rows
        buckets = self._buckets(count + about)
        generation, write = uuid.uuid4().hex, uuid.uuid4().hex
        self._write(rows, generation, buckets, write)
        return Row(generation=generation, buckets=buckets, writes=[write] if count else [], base_rows=count, rows=count)

    def _write(self, rows: DataFrame, generation: str, buckets: int, write: str) -> int:
        """Write the folder that becomes the partition ``write``, and count its rows.

        A catalog entry of its own, which goes at the end, names the folder: writers of
        one table so have no folder in common whose temporary files the first to end
        would delete.
        """
        counted = Observation()
        name = f"{self._name(generation)}_{write}"
        self._create(name, buckets, f"{self.path}/rows/{generation}/_write={write}")
        try:
            (
                rows.select(*self.columns, "version")
                .repartition(buckets, *self.key_cols)
                .observe(counted, F.count("*").alias("rows"))
                .write.insertInto(name)
            )
            return counted.get["rows"]
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _commit(self, version: int, run_id: str, *values) -> None:
        entry = json.dumps(dict(zip(_COMMITS.names, (version, run_id, *values))))
        if not publish_once(self.spark, f"{self.path}/commits/{version:012d}.json", entry):
            raise ValueError(f"another run has committed version {version} of {self.path}")

    def _tidy(self) -> None:
        """Delete the files of generations that newer ones have replaced.

        Only those that a commit has named: another one may be a rewrite under way.
        """
        named = list(dict.fromkeys(c.generation for c in self.commits()))
        old = set(named[:-KEPT_GENERATIONS])
        for generation in names(self.spark, f"{self.path}/rows"):
            if generation in old:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(generation)}")
                delete(self.spark, f"{self.path}/rows/{generation}")

    def _schema(self) -> T.StructType:
        kinds = dict.fromkeys(self.columns, T.StringType()) | {"page": T.LongType(), "version": T.LongType()}
        return T.StructType([T.StructField(c, kinds[c]) for c in (*self.columns, "version")])

    def _name(self, generation: str) -> str:
        return f"tidemark_{md5(self.path.encode()).hexdigest()[:16]}_{generation}"

    def _declare(self, generation: str, buckets: int) -> str:
        """Name of the catalog entry over a generation's folder, made if missing."""
        name = self._name(generation)
        if not self.spark.catalog.tableExists(name):
            self._create(name, buckets, f"{self.path}/rows/{generation}", "_write")
        return name

    def _create(self, name: str, buckets: int, place: str, partition: str | None = None) -> None:
        keys = ", ".join(f"`{c}`" for c in self.key_cols)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema())
        more, by = (f", `{partition}` STRING", f" PARTITIONED BY (`{partition}`)") if partition else ("", "")
        place = place.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}{more}) USING parquet{by}"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )

    def forget(self) -> None:
        """Drop the catalog's entries of this table; its files stay."""
        for generation in {c.generation for c in self.commits()}:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(generation)}")
