"""The whole incremental run: load, cleanup, process, persist."""

from __future__ import annotations

import datetime as dt
import logging
import re
import time
import uuid
from dataclasses import asdict, dataclass, field, fields
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import RunConfig
from tidemark.operators.changes import REPEATED, change_detect
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.enrich import SAVE, enrich_tagged, unmatched_sample
from tidemark.operators.lookup import Ask
from tidemark.plans.cleanup import cleanup, is_valid, latest_row_counters
from tidemark.plans.process import LookupReport, lookup_enrich, transform
from tidemark.plans.report import RunReport
from tidemark.plans.steps import StepLog
from tidemark.sources.cache_table import CacheTable
from tidemark.sources.files import delete
from tidemark.sources.partitions import latest_partition_scan, list_partitions
from tidemark.sources.state_table import StateTable
from tidemark.sources.views import publish_output, publish_view

logger = logging.getLogger(__name__)


@dataclass
class RunResult:
    """The report, what became of the lookup's pages and, after a successful run, the delivered rows, and those published if asked for."""

    report: RunReport = field(default_factory=RunReport)
    lookup: LookupReport = field(default_factory=LookupReport)
    output: DataFrame | None = None
    published: DataFrame | None = None


def run_incremental(
    spark: SparkSession,
    config: RunConfig,
    table: DataFrame | str,
    ask: Ask,
    run_date: dt.date,
    run_id: str | None = None,
    partitions: DataFrame | None = None,
    raise_errors: bool = True,
) -> RunResult:
    """Run over the newest recent day of ``table``, partitioned by year/month/day.

    ``table`` is best a catalog table's name: then the days are read from the
    catalog. Of a DataFrame the days must be listed in ``partitions``, or the
    recent days' rows are read for them. ``run_id`` names one run: a run that
    failed is repeated under its id and keeps the answers it got; one that is
    committed to the state is not run again. A repeat goes on at the step that
    failed, and does not read ``table`` again once its rows are staged, unless the
    state, the run date or the configuration are other ones by then. Without an id
    it is the run date, with a number where that run is already committed. Pages
    that the lookup failed on do not fail the run: they are counted in ``lookup`` and
    named in the report's ``additional_info``. With ``raise_errors`` off, an error ends
    up in the report, beside the sections finished before it.
    """
    started = time.monotonic()
    result = RunResult()
    try:
        run = _Run(spark, config, run_date, run_id, result)
        output = run.resumed("deliver")
        if output is None:
            staged = run.resumed("stage")
            if staged is None:
                staged = run.stage(run.load(table, partitions, run_date))
            output = run.deliver(staged, ask)
        result.output = output = run.delivered(output)
        run.persist(output)
        if config.output_cols:
            result.published = run.publish(output)
        run.tidy()
        result.report.status = "success"
        result.report.additional_info = result.lookup.trouble()
    except Exception as error:
        result.output = None
        result.report.status = "error"
        result.report.additional_info = str(error)
        if raise_errors:
            raise
    finally:
        result.report.elapsed = time.monotonic() - started
    return result


class _Run:
    """One run's tables and steps.

    Each step ends in a write, and the next one reads what was written; the step
    log says where. The counters are observed in the stage that writes: there a
    retried task counts once, in the stages before it may count again.
    """

    def __init__(
        self, spark: SparkSession, config: RunConfig, run_date: dt.date, run_id: str | None, result: RunResult
    ) -> None:
        if run_id is not None and not re.fullmatch(r"[0-9A-Za-z.-]+", run_id):
            raise ValueError(f"run id {run_id!r} must be letters, digits, dots and dashes")
        self.spark = spark
        self.config = config
        self.report = result.report
        self.lookup = result.lookup
        self.state = StateTable(spark, f"{config.root}/state", config.key_cols, config.state_buckets)
        self.cache = CacheTable(spark, f"{config.root}/cache", config.state_buckets)
        commits = self.state.commits()
        committed = {commit.run_id for commit in commits}
        if run_id in committed:
            raise ValueError(f"run {run_id!r} is already committed to the state")
        names = (run_date.isoformat() + suffix for suffix in ("", *(f"-{n}" for n in range(2, len(committed) + 3))))
        self.run_id = run_id or next(name for name in names if name not in committed)
        settings = [(f.name, getattr(config, f.name)) for f in fields(config)]
        basis = {
            "state_version": commits[-1].version if commits else None,
            "run_date": run_date.isoformat(),
            "config": sha256(repr(settings).encode()).hexdigest(),
        }
        self.log = StepLog(spark, self.path("steps"), basis)

    def path(self, part: str) -> str:
        return f"{self.config.root}/{part}/run={self.run_id}"

    def new_path(self, part: str) -> str:
        """A folder that no other attempt writes to."""
        return f"{self.path(part)}/attempt={uuid.uuid4().hex}"

    def resumed(self, step: str) -> DataFrame | None:
        """What an earlier attempt's step has written; the report gets its counters."""
        entry = self.log.finished(step)
        if entry is None:
            return None
        logger.info("Run %s goes on after its step %s", self.run_id, step)
        self.report.sections.update(entry["sections"])
        for name, value in entry.get("lookup", {}).items():
            setattr(self.lookup, name, value)
        return self.log.table(entry)

    def publish_view(self, step: int, df: DataFrame) -> None:
        if self.config.publish_views:
            publish_view(df, self.config.view_names[step])

    def load(self, table: DataFrame | str, partitions: DataFrame | None, run_date: dt.date) -> DataFrame:
        config = self.config
        if isinstance(table, str):
            partitions = list_partitions(self.spark, table) if partitions is None else partitions
            table = self.spark.table(table)
        until = run_date if config.until_run_date else None
        raw, date_ref, predicate = latest_partition_scan(
            table, run_date, config.days_back, until, partitions
        )
        # Counting reads no column: the file footers know the row numbers.
        self.report.fill("load", date_ref=str(date_ref), predicate=predicate, row_count=raw.count())
        self.publish_view(0, raw)
        return schemas.keys_as_text(raw, {*config.key_cols, config.lookup_key})

    def stage(self, raw: DataFrame) -> DataFrame:
        """Clean and compare with the state; write the new and changed rows.

        One shuffle of the raw rows by key serves both. Rows without
        description or code stay in up to the last stage, to be counted.
        """
        config = self.config
        described = (config.description_col, config.code_col)
        tagged = change_detect(
            dedup_latest(raw, config.key_cols, config.order_cols),
            self.state.read(),
            config.key_cols,
            config.fingerprint_cols,
            config.null_token,
        )
        repeated = F.col("change") == REPEATED
        staging, place = Observation(), self.new_path("staged")
        tagged.observe(
            staging,
            *latest_row_counters(*described),
            F.count_if(is_valid(*described) & ~repeated).alias("new_count"),
            F.count_if(is_valid(*described) & repeated).alias("repeated_count"),
        ).where(is_valid(*described) & ~repeated).drop("change").write.parquet(place)
        counted = dict(staging.get)
        changes = {name: counted.pop(name) for name in ("new_count", "repeated_count")}
        raw_count = self.report.sections["load"]["row_count"]
        self.report.fill(
            "cleanup",
            raw_count=raw_count,
            duplicated_count=raw_count - counted["de_duplicated_count"],
            **counted,
        )
        self.report.note("process", raw_count=counted["valid_rows"], **changes)
        if config.publish_views:
            self.publish_view(1, cleanup(raw, config.key_cols, config.order_cols, *described))
        schema = tagged.drop("change").schema
        self.log.finish("stage", place, schema, self.report.sections)
        return self.spark.read.schema(schema).parquet(place)

    def deliver(self, staged: DataFrame, ask: Ask) -> DataFrame:
        """Look up, join, derive the entity ids; rows with and without an answer.

        All rows are written in one job, those without an answer beside the
        others: the sample of their ids is read from there.
        """
        config = self.config
        answers = lookup_enrich(
            staged,
            self.cache,
            ask,
            self.run_id,
            self.path("lookup"),
            config.lookup_key,
            config.page_size,
            config.pages_per_wave,
            self.lookup,
        )
        enriching, place = Observation(), self.new_path("output")
        answered = F.col("state") == SAVE
        tagged = enrich_tagged(staged, answers, config.lookup_key, config.hot_rows)
        # Observed between the two: within a condition the digest's parts would each be hashed for.
        derived = transform(tagged, config.secret, config.code_col).observe(
            enriching,
            F.count_if(answered).alias("matched_count"),
            F.count_if(~answered).alias("not_matched_count"),
        )
        derived = derived.withColumn("uuid", F.when(answered, F.col("uuid")))
        derived.write.partitionBy("state").parquet(place)
        counted = enriching.get
        written = self.spark.read.schema(derived.schema).parquet(place)
        if counted["not_matched_count"] and config.sample_size:
            unmatched = written.where(~answered)
            sample = unmatched_sample(unmatched, config.sample_size, config.lookup_key).collect()
            logger.warning("Not matched: [%s]", ",".join(str(row[0]) for row in sample))
        self.report.fill(
            "process",
            **counted,
            transformed_count=counted["matched_count"],
            valid_rows=counted["matched_count"],
        )
        self.log.finish("deliver", place, derived.schema, self.report.sections, lookup=asdict(self.lookup))
        return written

    def delivered(self, written: DataFrame) -> DataFrame:
        """The rows with an answer."""
        output = written.where(F.col("state") == SAVE).drop("state")
        self.publish_view(2, output)
        return output

    def persist(self, output: DataFrame) -> None:
        """Merge the delivered rows into the state.

        Rows without an answer stay out of it and so remain new.
        """
        delivered = self.report.sections["process"]["valid_rows"]
        self.state.upsert(output, self.run_id, about=delivered)
        self.report.fill("persist", raw_count=delivered, valid_rows=delivered)
        self.publish_view(3, output)

    def publish(self, output: DataFrame) -> DataFrame:
        """The chosen columns, written where other programs read them."""
        config = self.config
        publish_output(output, self.path("published"), config.output_cols, config.output_partition_cols)
        return self.spark.read.parquet(self.path("published"))

    def tidy(self) -> None:
        """Delete what only a repeat would have read; the lookup's responses stay."""
        self.log.clear()
        for part in ("staged", "lookup/known", "lookup/pages"):
            first, _, rest = part.partition("/")
            delete(self.spark, f"{self.path(first)}/{rest}".rstrip("/"))
