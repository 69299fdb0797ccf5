"""One query per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import RunConfig, RunResult, run_incremental
from tidemark import functions as fn
from tidemark import operators as op
from tidemark import plans, schemas, sources
from workload import tables as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SUNDAY = dt.date(2024, 1, 28)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


# Scans and sources


@query
def workday_anchor(spark, sf_dir):
    days = t.read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return days.distinct().select("day", fn.workday_anchor("day").alias("anchor"))


@query
def recent_partitions(spark, sf_dir):
    with t.day_table(spark, t.event_days(spark, sf_dir)) as name:
        return sources.recent_partitions(sources.list_partitions(spark, name), SUNDAY)


@query
def latest_partition(spark, sf_dir):
    with t.day_table(spark, t.event_days(spark, sf_dir)) as name:
        recent = sources.recent_partitions(sources.list_partitions(spark, name), SUNDAY)
    return sources.latest_partition(recent, SUNDAY)


@query
def latest_partition_scan(spark, sf_dir):
    events = t.event_days(spark, sf_dir)
    path = t.day_files(spark, events)
    with t.day_table(spark, events, path) as name:
        listing = sources.list_partitions(spark, name)
    newest, _, _ = sources.latest_partition_scan(spark.read.parquet(path), SUNDAY, until=SUNDAY, partitions=listing)
    return newest


@query
def catalog_partitions(spark, sf_dir):
    with t.day_table(spark, t.event_days(spark, sf_dir)) as name:
        return sources.list_partitions(spark, name)


@query
def view_scan(spark, sf_dir):
    sources.publish_view(t.raw(spark, sf_dir), "raw")
    return sources.scan_view(spark, "raw")


# Cleanup


@query
def dedup_latest(spark, sf_dir):
    return op.dedup_latest(t.raw(spark, sf_dir), t.KEYS, t.ORDER)


@query
def dedup_discarded(spark, sf_dir):
    return op.dedup_discarded(t.raw(spark, sf_dir), t.KEYS, t.ORDER)


@query
def dedup_latest_maps(spark, sf_dir):
    """Ties on a map column: equal maps may hold their entries in any order."""
    kind, props = (F.lit("kind"), F.col("event_type")), (F.lit("props"), F.col("props"))
    either = F.when(F.col("event_id") % 2 == 0, F.create_map(*kind, *props)).otherwise(F.create_map(*props, *kind))
    day = F.col("ts").cast("date").alias("day")
    latest = op.dedup_latest(t.read(spark, sf_dir, "events").select("user_id", day, either.alias("event")), ["user_id"], ["day"])
    return latest.select("user_id", "day", F.col("event")["kind"].alias("kind"), F.col("event")["props"].alias("props"))


@query
def require_description(spark, sf_dir):
    return op.require_description(t.raw(spark, sf_dir))


@query
def require_code(spark, sf_dir):
    return op.require_code(t.raw(spark, sf_dir))


@query
def cleanup(spark, sf_dir):
    return plans.cleanup(t.raw(spark, sf_dir), t.KEYS, t.ORDER)


@query
def cleanup_report(spark, sf_dir):
    return plans.cleanup_report(t.raw(spark, sf_dir), t.KEYS, t.ORDER)


# Fingerprints and UUIDs


@query
def row_fingerprint(spark, sf_dir):
    return t.read(spark, sf_dir, "documents").select(
        "doc_id",
        fn.row_fingerprint("lang", F.nullif("source", F.lit("web")), "doc_id", "text").alias("sha2"),
    )


@query
def row_fingerprint_null_token(spark, sf_dir):
    return t.raw(spark, sf_dir).select(
        "id", "code", "created_at", fn.row_fingerprint("code", "description", "id", null_token="\\N").alias("sha2")
    )


@query
def keyed_uuid(spark, sf_dir):
    order_id = F.col("o_orderkey").cast("string").alias("id")
    return t.read(spark, sf_dir, "orders").select(order_id).withColumn("uuid", fn.keyed_uuid("id", t.SECRET))


@query
def keyed_uuid_sql(spark, sf_dir):
    fn.register_keyed_uuid(spark, t.SECRET)
    sources.publish_view(t.read(spark, sf_dir, "documents"), "documents_to_name")
    return spark.sql(
        "SELECT doc_id, deterministic_uuid(text) AS uuid,"
        " deterministic_uuid(nullif(lang, 'en')) AS lang_uuid FROM documents_to_name"
    )


@query
def derive_entity_id(spark, sf_dir):
    lines = t.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("code")
    )
    return plans.transform(lines.distinct().withColumn("uuid", fn.keyed_uuid("id", t.SECRET)), t.SECRET)


# Change filter and state


@query
def change_detect(spark, sf_dir):
    return op.change_detect(t.batch(spark, sf_dir), t.state(spark, sf_dir), t.KEYS, t.FINGERPRINT)


@query
def rows_to_save(spark, sf_dir):
    return op.rows_to_save(change_detect(spark, sf_dir))


@query
def change_detect_by_code(spark, sf_dir):
    batch = t.by_part(t.batch(spark, sf_dir))
    earlier = t.by_part(plans.cleanup(t.earlier_raw(spark, sf_dir), t.KEYS, t.ORDER))
    state = earlier.select(*t.KEYS, fn.row_fingerprint(*t.FINGERPRINT).alias("sha2"))
    return op.change_detect_by_code(t.staged(spark, batch), t.staged(spark, state), t.FINGERPRINT)


def _fingerprinted(spark, sf_dir):
    return t.batch(spark, sf_dir).select(*t.KEYS, fn.row_fingerprint(*t.FINGERPRINT).alias("sha2"))


@query
def state_upsert(spark, sf_dir):
    return op.state_upsert(t.state(spark, sf_dir), _fingerprinted(spark, sf_dir), t.KEYS)


@query
def state_upsert_by_id(spark, sf_dir):
    state = t.staged(spark, t.state(spark, sf_dir))
    return op.state_upsert_by_id(state, t.staged(spark, _fingerprinted(spark, sf_dir)))


@query
def bootstrap_empty_state(spark, sf_dir):
    empty = sources.StateTable(spark, sources.new_folder(spark, "state"), t.KEYS).read()
    return op.change_detect(t.cleaned(spark, sf_dir), empty, t.KEYS, t.FINGERPRINT)


@query
def state_upsert_roundtrip(spark, sf_dir):
    table = sources.StateTable(spark, sources.new_folder(spark, "state"), t.KEYS)
    table.upsert(t.state(spark, sf_dir), "earlier")
    table.upsert(_fingerprinted(spark, sf_dir), "this")
    return table.read()


# Lookup and enrichment


@query
def unseen_keys(spark, sf_dir):
    return op.unseen_keys(t.cleaned(spark, sf_dir), t.small_cache(spark, sf_dir))


@query
def lookup_batches(spark, sf_dir):
    return op.assign_pages(op.unseen_keys(t.cleaned(spark, sf_dir), t.small_cache(spark, sf_dir)))


@query
def parse_lookup_response(spark, sf_dir):
    ids = t.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    responses = t.ask(spark, sf_dir)(op.lookup_pages(op.assign_pages(ids)))
    return op.parse_responses(responses, "2000-01-01")


@query
def lookup_function(spark, sf_dir):
    secret = t.SECRET

    def fetch(page, ids):
        import hashlib
        import hmac
        import json
        import uuid

        def answer(key):
            digest = hmac.new(secret, key.encode(), hashlib.sha256).digest()
            return {"id": key, "uuid": str(uuid.UUID(bytes=digest[:16], version=4))}

        return 200, json.dumps([answer(key) for key in ids])

    unseen = op.unseen_keys(t.cleaned(spark, sf_dir), t.small_cache(spark, sf_dir))
    responses = op.ask_function(fetch, 8)(op.lookup_pages(op.assign_pages(unseen)))
    return op.parse_responses(responses, "2000-01-01")


@query
def cache_append_roundtrip(spark, sf_dir):
    cache = sources.CacheTable(spark, sources.new_folder(spark, "cache"))
    cache.append(t.small_cache(spark, sf_dir), "1999-12-31")
    cache.append(parse_lookup_response(spark, sf_dir), "2000-01-01")
    return cache.read().select("uuid", "id", "partition_ref")


@query
def latest_answers(spark, sf_dir):
    events = t.read(spark, sf_dir, "events")
    return op.latest_answers(
        events.select(
            fn.keyed_uuid(F.col("event_id").cast("string"), t.SECRET).alias("uuid"),
            F.col("user_id").cast("string").alias("id"),
            F.concat_ws("_", F.date_format("ts", "yyyy-MM-dd"), F.hour("ts")).alias("partition_ref"),
            F.unix_date(F.col("ts").cast("date")).alias("version"),
            F.hour("ts").alias("page"),
        )
    )


@query
def lookup_enrich(spark, sf_dir):
    folder = sources.new_folder(spark, "lookup")
    cache = sources.CacheTable(spark, f"{folder}/cache")
    cache.append(t.small_cache(spark, sf_dir), "1999-12-31")
    batch = t.staged_rows(spark, sf_dir)
    ask = t.ask(spark, sf_dir)
    answers = plans.lookup_enrich(batch, cache, ask, "2000-01-01", folder)
    return op.enrich_tagged(batch, answers)


@query
def lookup_retry(spark, sf_dir):
    """A run repeated under its id while the service is down: what was answered first is kept, nothing else comes."""
    folder = sources.new_folder(spark, "lookup")
    cache = sources.CacheTable(spark, f"{folder}/cache")
    batch = t.staged_rows(spark, sf_dir)
    finished = t.service(spark, sf_dir).where("o_orderstatus = 'F'")
    down = op.ask_table(finished.where("false"))
    for ask in (op.ask_table(finished), down):
        answers = plans.lookup_enrich(batch, cache, ask, "2000-01-01", folder)
    return op.enrich_tagged(batch, answers)


def _troubled(spark, sf_dir, *later, **options):
    """Answers of a run that meets a troubled service, and is repeated under its id with each of the services in ``later``."""
    folder = sources.new_folder(spark, "lookup")
    cache = sources.CacheTable(spark, f"{folder}/cache")
    cache.append(t.small_cache(spark, sf_dir), "1999-12-31")
    batch = t.staged_rows(spark, sf_dir)
    ask = t.ask(spark, sf_dir)
    for service in (t.troubled(ask), *(s(ask) for s in later)):
        answers = plans.lookup_enrich(batch, cache, service, "2000-01-01", folder, **options)
    return op.enrich_tagged(batch, answers), folder


@query
def lookup_malformed(spark, sf_dir):
    """Pages whose body cannot be read, or that fail, leave their ids unmatched; the others' answers count."""
    return _troubled(spark, sf_dir)[0]


@query
def lookup_malformed_retry(spark, sf_dir):
    """The run repeated under its id with a sound service: what is missing is asked for, and nothing else."""
    return _troubled(spark, sf_dir, lambda ask: ask)[0]


@query
def lookup_report(spark, sf_dir):
    """What became of the pages, sent in waves of four."""
    report = plans.LookupReport()
    _troubled(spark, sf_dir, pages_per_wave=4, report=report)
    return report.to_df(spark)


@query
def malformed_pages(spark, sf_dir):
    """The bodies that could not be read, as a run keeps them apart."""
    _, folder = _troubled(spark, sf_dir)
    return sources.read_if_there(spark, f"{folder}/malformed", schemas.MALFORMED).select(*schemas.MALFORMED.names)


@query
def page_waves(spark, sf_dir):
    ids = t.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    waves = op.page_waves(op.lookup_pages(op.assign_pages(ids)), 4)
    return waves.groupBy("wave").agg(F.count("*").alias("pages"), F.sum(F.size("ids")).alias("ids"))


@query
def enrich_tagged(spark, sf_dir):
    return op.enrich_tagged(t.staged_rows(spark, sf_dir), t.cache(spark, sf_dir))


@query
def enrich_matched(spark, sf_dir):
    return op.enrich_matched(t.staged_rows(spark, sf_dir), t.cache(spark, sf_dir))


@query
def enrich_unmatched(spark, sf_dir):
    return op.enrich_unmatched(t.staged_rows(spark, sf_dir), t.cache(spark, sf_dir))


@query
def enrich_full_outer(spark, sf_dir):
    return op.enrich_full_outer(t.staged_rows(spark, sf_dir), t.full_cache(spark, sf_dir))


@query
def enrich_documents(spark, sf_dir):
    documents = t.read(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    labels = t.read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        fn.keyed_uuid(F.concat_ws("||", "doc_id", "quality", "toxic"), t.SECRET).alias("uuid"),
        F.lit("2024-05-10_1").alias("partition_ref"),
    )
    return op.enrich_tagged(documents.drop("doc_id"), labels)


@query
def unmatched_sample(spark, sf_dir):
    unmatched = op.enrich_unmatched(t.staged_rows(spark, sf_dir), t.cache(spark, sf_dir))
    return op.unmatched_sample(unmatched)


@query
def process_report(spark, sf_dir):
    return plans.process_report(
        t.batch(spark, sf_dir), t.state(spark, sf_dir), t.cache(spark, sf_dir), t.KEYS, t.FINGERPRINT
    )


@query
def publish_output(spark, sf_dir):
    matched = op.enrich_matched(t.staged_rows(spark, sf_dir), t.cache(spark, sf_dir))
    path = sources.new_folder(spark, "output")
    columns = ["uuid", "id", "code", "group_id"]
    sources.publish_output(plans.transform(matched, t.SECRET), path, columns, ["group_id"])
    return spark.read.parquet(path).select(*columns[:3], F.col("group_id").cast("long"))


# Whole runs


def _runs(
    spark: SparkSession, sf_dir: str, *runs: tuple[dt.date, str | None], interrupted: bool = False, **options
) -> tuple[RunResult, sources.StateTable]:
    """Runs one after another over the day-partitioned raw rows; the last one's result.

    ``interrupted``: the last one fails in the lookup and is repeated when the raw table is gone.
    """
    config = RunConfig(
        sources.new_folder(spark, "run"), t.SECRET, t.KEYS, t.ORDER, t.FINGERPRINT, until_run_date=True, **options
    )
    ask = t.ask(spark, sf_dir)
    with t.day_table(spark, t.raw_days(spark, sf_dir)) as table:
        for run_date, run_id in runs:
            broken = interrupted and run_id == runs[-1][1]
            result = run_incremental(spark, config, table, _broken if broken else ask, run_date, run_id, raise_errors=False)
    if interrupted:
        result = run_incremental(spark, config, table, ask, *runs[-1], raise_errors=False)
    return result, sources.StateTable(spark, f"{config.root}/state", t.KEYS)


def _broken(pages: DataFrame) -> DataFrame:
    lost = F.raise_error(F.lit("the service is gone"))
    return pages.select("page", lost.cast("int").alias("status"), F.lit(None).cast("string").alias("body"))


FIRST = (t.EARLIER_DAY, "2024-05-09")
SECOND = (t.THIS_DAY, "2024-05-10")
AGAIN = (t.THIS_DAY, None)  # the day's second run


def _report(spark: SparkSession, result: RunResult) -> DataFrame:
    return result.report.to_df(spark).where("name <> 'elapsed'")


@query
def incremental_run(spark, sf_dir):
    result, _ = _runs(spark, sf_dir, FIRST, SECOND)
    return result.output


@query
def run_report(spark, sf_dir):
    result, _ = _runs(spark, sf_dir, FIRST, SECOND)
    return _report(spark, result)


@query
def resumed_run(spark, sf_dir):
    """A run that failed in the lookup goes on there: its report, the raw table having gone."""
    result, _ = _runs(spark, sf_dir, FIRST, SECOND, interrupted=True)
    return _report(spark, result)


@query
def resumed_output(spark, sf_dir):
    result, _ = _runs(spark, sf_dir, FIRST, SECOND, interrupted=True)
    return result.output


@query
def incremental_rerun(spark, sf_dir):
    _, state = _runs(spark, sf_dir, FIRST, SECOND, AGAIN)
    return state.read()


@query
def rerun_report(spark, sf_dir):
    result, _ = _runs(spark, sf_dir, FIRST, SECOND, AGAIN)
    return _report(spark, result)


@query
def run_report_json(spark, sf_dir):
    """The report's JSON, read again: a row for each counter of a section."""
    result, _ = _runs(spark, sf_dir, FIRST, SECOND)
    text = spark.createDataFrame([(result.report.to_json(),)], "report string")
    entries = "map<string,string>"
    sections = F.from_json("report", f"struct<load {entries}, cleanup {entries}, process {entries}, persist {entries}>")
    names = ("load", "cleanup", "process", "persist")
    named = F.array(*(F.struct(F.lit(n).alias("section"), sections[n].alias("entries")) for n in names))
    return text.select(F.inline(named)).select("section", F.explode("entries").alias("name", "value"))


@query
def error_report(spark, sf_dir):
    """A committed run asked for again: it ends as an error, and the report says which."""
    result, _ = _runs(spark, sf_dir, FIRST, FIRST)
    return _report(spark, result).where("section = 'run' or value = 'unknown'")


@query
def incremental_output(spark, sf_dir):
    """The chosen columns that a run publishes."""
    columns = ("uuid", "id", "code", "group_id")
    result, _ = _runs(spark, sf_dir, FIRST, SECOND, output_cols=columns, output_partition_cols=("group_id",))
    return result.published.select(*columns[:3], F.col("group_id").cast("long"))


QUERIES["cleanup_pipeline"] = QUERIES["cleanup"]
QUERIES["incremental_pipeline"] = QUERIES["incremental_run"]
