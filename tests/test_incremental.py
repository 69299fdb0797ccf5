from __future__ import annotations

import datetime as dt
import json
import logging
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import RunConfig, run_incremental
from tidemark.functions import keyed_uuid
from tidemark.operators import ask_function, ask_table
from tidemark.plans import cleanup, cleanup_report, lookup_enrich
from tidemark.plans.report import SECTIONS
from tidemark.sources import CacheTable, StateTable, new_folder

SECRET = b"my-unique-secret"
RUN_DATE = dt.date(2024, 5, 13)
SCHEMA = "id long, code string, group_id long, created_at timestamp, description string"
CODE = "abcde12345"

# The rows of the example job and, below, the report they give.
GOLDEN = [
    (123456789, CODE, 2, dt.datetime(2024, 5, 8), "The Description"),
    (123456789, CODE, 2, dt.datetime(2024, 5, 9), "The Description"),
    (987654321, CODE, 2, dt.datetime(2024, 5, 8), "One more description"),
    (123454321, None, 2, dt.datetime(2024, 5, 10), "This is a description"),
    (123456321, CODE, 2, dt.datetime(2024, 5, 10), None),
]


def day_table(spark, data, *dates, schema=SCHEMA):
    """The same rows in a partition of each date."""
    path = new_folder(spark, "table")
    df = spark.createDataFrame(data, schema)
    for d in dates:
        df.write.parquet(f"{path}/year={d.year}/month={d.month}/day={d.day}")
    return spark.read.parquet(path)


def service(spark, ids):
    df = spark.createDataFrame([(str(i),) for i in ids], "id string")
    return df.withColumn("uuid", keyed_uuid("id", SECRET))


def config(spark, **changes):
    return RunConfig(new_folder(spark, "root"), SECRET, **changes)


@pytest.fixture
def golden(spark):
    # Monday's anchor is the day itself: only later than Saturday qualifies.
    return day_table(spark, GOLDEN, dt.date(2024, 5, 9), dt.date(2024, 5, 10))


FRIDAY = dt.date(2024, 5, 10)


def test_golden_run(spark, golden):
    conf = config(spark, publish_views=True)
    ask = ask_table(service(spark, [123456789, 987654321]))
    result = run_incremental(spark, conf, golden, ask, FRIDAY, "2024-05-13")
    report = json.loads(result.report.to_json())
    assert report.pop("elapsed") > 0
    assert report == {
        "status": "success",
        "additional_info": None,
        "load": {"date_ref": "2024-05-10", "predicate": "year=2024 and month=05 and day=10", "row_count": 5, "status": "success"},
        "cleanup": {
            "raw_count": 5,
            "duplicated_count": 1,
            "de_duplicated_count": 4,
            "no_description": 1,
            "description_count": 3,
            "no_code_count": 1,
            "code_count": 2,
            "valid_rows": 2,
            "status": "success",
        },
        "process": {
            "raw_count": 2,
            "matched_count": 2,
            "not_matched_count": 0,
            "new_count": 2,
            "repeated_count": 0,
            "transformed_count": 2,
            "valid_rows": 2,
            "status": "success",
        },
        "persist": {"raw_count": 2, "valid_rows": 2, "status": "success"},
    }
    expected = [
        ("123456789", "f3eeaba753707898074257689d058003889a7d9c4b224905304e75ec5c18a006", "1bb1512f-8e33-4207-8167-4d3c0bcf85b9", "2024-05-13_1"),
        ("987654321", "fca19938d17fe12b7f5041b228175785b61b77be3f818532789fa72e3056101a", "81b4c2a0-5478-4fcb-80d8-e3645341baf0", "2024-05-13_1"),
    ]
    assert rows(result.output.select("id", "sha2", "uuid", "partition_ref")) == expected
    state = StateTable(spark, f"{conf.root}/state").read()
    assert rows(state) == sorted((i, CODE, sha) for i, sha, _, _ in expected)
    assert spark.table("raw").count() == 5 and spark.table("cleanup").count() == 2
    assert rows(spark.table("process")) == rows(spark.table("persisted")) == rows(result.output)

    again = run_incremental(spark, conf, golden, ask, FRIDAY, "2024-05-13-2")
    process = again.report.sections["process"]
    assert (process["new_count"], process["repeated_count"], again.output.count()) == (0, 2, 0)
    assert rows(StateTable(spark, f"{conf.root}/state").read()) == rows(state)


def test_committed_run_is_not_repeated(spark, golden):
    conf = config(spark)
    ask = ask_table(service(spark, [123456789]))
    run_incremental(spark, conf, golden, ask, FRIDAY, "r1")
    with pytest.raises(ValueError, match="already committed"):
        run_incremental(spark, conf, golden, ask, FRIDAY, "r1")


def test_second_run_of_a_day(spark, golden):
    conf = config(spark)
    first = run_incremental(spark, conf, golden, ask_table(service(spark, [123456789])), FRIDAY)
    second = run_incremental(spark, conf, golden, ask_table(service(spark, [123456789, 987654321])), FRIDAY)
    third = run_incremental(spark, conf, golden, ask_table(service(spark, [])), FRIDAY)
    counts = [[r.report.sections["process"][c] for c in ("new_count", "matched_count")] for r in (first, second, third)]
    assert counts == [[2, 1], [1, 1], [0, 0]]
    ids = [c.run_id for c in StateTable(spark, f"{conf.root}/state").commits()]
    assert ids == ["2024-05-10", "2024-05-10-2", "2024-05-10-3"]


def rows_to_ask(spark):
    return day_table(spark, [(i, "a", 1, dt.datetime(2024, 5, 9), "d") for i in range(30)], FRIDAY)


def all_answered(page, ids):
    return 200, json.dumps([{"id": i, "uuid": "u" + i} for i in ids])


@pytest.mark.parametrize("lost_in", ["upsert", "append"])
def test_a_repeated_run_keeps_its_answers_and_asks_for_none_again(spark, monkeypatch, lost_in):
    table, conf = rows_to_ask(spark), config(spark, page_size=10)

    def lost(self, *args, **named):
        raise RuntimeError("executors lost")

    def down(page, ids):
        return 503, None

    with monkeypatch.context() as patch:
        patch.setattr(StateTable if lost_in == "upsert" else CacheTable, lost_in, lost)
        assert run_incremental(spark, conf, table, ask_function(all_answered, 2), FRIDAY, "r1", raise_errors=False).report.status == "error"
    redone = run_incremental(spark, conf, table, ask_function(down, 2), FRIDAY, "r1")
    assert redone.report.sections["process"]["matched_count"] == 30
    cache = CacheTable(spark, f"{conf.root}/cache").read()
    assert cache.count() == cache.select("id").distinct().count() == 30
    requests = spark.read.parquet(f"{conf.root}/lookup/run=r1/responses")
    assert requests.count() == 3 and requests.where("status <> 200").isEmpty()


def test_ids_known_to_have_no_answer_are_not_asked_again(spark):
    table, conf, asked = rows_to_ask(spark), config(spark, page_size=10), []

    def no_uuids(page, ids):
        return 200, json.dumps([{"id": i, "uuid": None} for i in ids])

    for run in ("r1", "r2"):
        result = run_incremental(spark, conf, table, ask_function(no_uuids, 2), FRIDAY, run)
        assert result.report.sections["process"]["not_matched_count"] == 30
        asked.append(spark.read.parquet(f"{conf.root}/lookup/run={run}/responses").count())
    assert asked == [3, 0] and CacheTable(spark, f"{conf.root}/cache").read().count() == 30


def test_failing_pages_are_named(spark, caplog):
    def fails(page, ids):
        return (500, "why") if page == 2 else all_answered(page, ids)

    with caplog.at_level(logging.WARNING, logger="tidemark"):
        run_incremental(spark, config(spark, page_size=10), rows_to_ask(spark), ask_function(fails, 2), FRIDAY)
    assert "{500: 1}" in caplog.text and "first ones: [2]" in caplog.text and "responses/attempt=" in caplog.text


def test_published_columns(spark, golden):
    conf = config(spark, output_cols=("uuid", "id", "code"), output_partition_cols=("code",))
    result = run_incremental(spark, conf, golden, ask_table(service(spark, [123456789])), FRIDAY, "r1")
    assert sorted(result.published.columns) == ["code", "id", "uuid"] and result.published.count() == 1
    assert os.path.isdir(f"{conf.root}/published/run=r1/code={CODE}")


def test_views_come_as_each_step_ends(spark, golden, monkeypatch):
    for name in ("raw", "cleanup", "process", "persisted"):
        spark.catalog.dropTempView(name)

    def lost(self, batch, run_id, about=None):
        raise RuntimeError("lost")

    monkeypatch.setattr(StateTable, "upsert", lost)
    run_incremental(spark, config(spark, publish_views=True), golden, ask_table(service(spark, [1])), FRIDAY, raise_errors=False)
    assert [spark.catalog.tableExists(n) for n in ("raw", "cleanup", "process", "persisted")] == [True, True, True, False]


def test_days_come_from_the_catalog(spark, golden):
    path = golden.inputFiles()[0].split("/year=")[0]
    spark.sql(f"CREATE TABLE golden_days (id LONG, code STRING, group_id LONG, created_at TIMESTAMP, description STRING, year INT, month INT, day INT) USING parquet PARTITIONED BY (year, month, day) LOCATION '{path}'")
    spark.sql("MSCK REPAIR TABLE golden_days")
    result = run_incremental(spark, config(spark), "golden_days", ask_table(service(spark, [123456789])), FRIDAY)
    assert result.report.sections["load"] == {"date_ref": "2024-05-10", "predicate": "year=2024 and month=05 and day=10", "row_count": 5, "status": "success"}
    spark.sql("DROP TABLE golden_days")


def test_unmatched_rows_stay_new(spark, golden, caplog):
    conf = config(spark)
    with caplog.at_level(logging.WARNING, logger="tidemark"):
        first = run_incremental(spark, conf, golden, ask_table(service(spark, [123456789])), FRIDAY, "r1")
    assert "Not matched: [987654321]" in caplog.text
    assert first.report.sections["process"]["not_matched_count"] == 1
    second = run_incremental(spark, conf, golden, ask_table(service(spark, [987654321])), FRIDAY, "r2")
    process = second.report.sections["process"]
    assert (process["new_count"], process["repeated_count"], process["matched_count"]) == (1, 1, 1)
    assert rows(second.output.select("id", "partition_ref")) == [("987654321", "r2_1")]


def test_failed_and_empty_pages_are_retried(spark, caplog):
    data = [(i, "a", 1, dt.datetime(2024, 5, 9), "d") for i in range(30)]
    table = day_table(spark, data, FRIDAY)

    def flaky(page, ids):
        if page > 1:
            return {2: 204, 3: 503}[page], None
        return 200, json.dumps([{"id": i, "uuid": "u" + i} for i in ids])

    def steady(page, ids):
        return 200, json.dumps([{"id": i, "uuid": "u" + i} for i in ids])

    conf = config(spark, page_size=10)
    with caplog.at_level(logging.WARNING, logger="tidemark"):
        first = run_incremental(spark, conf, table, ask_function(flaky, 2), FRIDAY, "r1")
    assert "{204: 1, 503: 1}" in caplog.text or "{503: 1, 204: 1}" in caplog.text
    assert first.output.count() == 10
    second = run_incremental(spark, conf, table, ask_function(steady, 2), FRIDAY, "r2")
    assert second.output.count() == 20
    assert StateTable(spark, f"{conf.root}/state").read().count() == 30


def test_interrupted_run_is_repeated_under_its_id(spark, golden, monkeypatch):
    conf = config(spark)
    ask = ask_table(service(spark, [123456789, 987654321]))
    upsert = StateTable.upsert

    def lost(self, batch, run_id, about=None):
        raise RuntimeError("executors lost")

    monkeypatch.setattr(StateTable, "upsert", lost)
    failed = run_incremental(spark, conf, golden, ask, FRIDAY, "r1", raise_errors=False)
    assert failed.report.status == "error" and failed.report.additional_info == "executors lost"
    assert failed.report.sections["process"]["status"] == "success"
    assert failed.report.sections["persist"] == {"raw_count": None, "valid_rows": None, "status": "unknown"}
    monkeypatch.setattr(StateTable, "upsert", upsert)
    redone = run_incremental(spark, conf, golden, ask, FRIDAY, "r1")
    assert redone.report.sections["process"]["matched_count"] == 2
    assert CacheTable(spark, f"{conf.root}/cache").read().count() == 2


def test_failing_tasks_are_retried_and_counted_once(spark, golden):
    folder = tempfile.mkdtemp()

    def first_time(name):
        try:
            open(f"{folder}/{name}", "x").close()
        except FileExistsError:
            return False
        return True

    @F.udf("string")
    def flaky(text):
        if text and first_time("read"):
            raise OSError("lost while reading")
        return text

    def fetch(page, ids):
        if first_time("fetch"):
            raise OSError("lost while asking")
        return 200, json.dumps([{"id": i, "uuid": "u" + i} for i in ids])

    table = golden.withColumn("description", flaky("description"))
    result = run_incremental(spark, config(spark), table, ask_function(fetch, 2), FRIDAY)
    assert sorted(os.listdir(folder)) == ["fetch", "read"]
    cleaned, process = (result.report.sections[s] for s in ("cleanup", "process"))
    assert (cleaned["de_duplicated_count"], cleaned["no_description"], cleaned["valid_rows"]) == (4, 1, 2)
    assert (process["new_count"], process["matched_count"], result.output.count()) == (2, 2, 2)


def test_reports_do_not_leak_between_runs(spark, golden):
    ask = ask_table(service(spark, [123456789]))
    bad = run_incremental(spark, config(spark), golden, ask, FRIDAY, "not/allowed", raise_errors=False)
    assert bad.report.status == "error"
    assert {s["status"] for s in bad.report.sections.values()} == {"unknown"}


def test_other_columns(spark):
    schema = "doc string, lang string, seen int, text string"
    data = [("x", "en", 1, "old"), ("x", "en", 2, "new"), ("y", "fr", 1, None), ("abc", "de", 1, "t")]
    table = day_table(spark, data, FRIDAY, schema=schema)
    conf = config(
        spark,
        key_cols=("doc", "lang"),
        order_cols=("seen",),
        fingerprint_cols=("doc", "lang", "text"),
        description_col="text",
        code_col="lang",
        lookup_key="doc",
        hot_rows=1,
    )
    result = run_incremental(spark, conf, table, ask_table(service(spark, ["x", "abc"])), FRIDAY)
    assert rows(result.output.select("doc", "lang", "text")) == [("abc", "de", "t"), ("x", "en", "new")]
    assert result.report.sections["cleanup"]["no_description"] == 1
    assert result.report.sections["process"]["matched_count"] == 2


def test_newest_row_without_description_drops_the_key(spark):
    df = spark.createDataFrame(
        [("1", "a", 1, "filled"), ("1", "a", 2, None), ("2", None, 1, "d"), ("2", None, 2, "d")],
        "id string, code string, created_at int, description string",
    )
    assert cleanup(df, ["id", "code"], ["created_at"]).isEmpty()
    assert cleanup_report(df, ["id", "code"], ["created_at"]).first().asDict() == {
        "raw_count": 4,
        "duplicated_count": 2,
        "de_duplicated_count": 2,
        "no_description": 1,
        "description_count": 1,
        "no_code_count": 1,
        "code_count": 0,
        "valid_rows": 0,
    }


def test_staging_shuffles_the_batch_once(spark, golden):
    """The same shuffle serves the deduplication and the comparison with the state."""
    from tidemark.operators import change_detect, dedup_latest

    state = StateTable(spark, new_folder(spark, "state"), buckets=4)
    state.upsert(spark.range(9).select(F.col("id").cast("string"), F.lit("a").alias("code"), F.lit("h").alias("sha2")), "r0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        raw = golden.withColumn("id", F.col("id").cast("string"))
        tagged = change_detect(dedup_latest(raw, ["id", "code"], ["created_at"]), state.read(), ["id", "code"], ["id"])
        plan = tagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2


def test_report_rejects_unknown_counters():
    from tidemark import RunReport

    with pytest.raises(KeyError):
        RunReport().fill("load", rows=1)
    assert set(RunReport().sections) == set(SECTIONS)


def html(page, ids):
    return (200, "<html>busy</html>") if page == 2 else all_answered(page, ids)


def test_a_malformed_body_does_not_block_the_run(spark, caplog):
    """Its ids stay unmatched and are asked for in the next run; the run ends, and says what happened."""
    table, conf = rows_to_ask(spark), config(spark, page_size=10)
    with caplog.at_level(logging.WARNING, logger="tidemark"):
        first = run_incremental(spark, conf, table, ask_function(html, 2), FRIDAY)
    assert (first.report.status, first.report.additional_info) == ("success", "lookup: 1 of 3 pages malformed")
    assert (first.lookup.answered, first.lookup.malformed, first.lookup.failed) == (2, 1, 0)
    assert first.report.sections["process"]["not_matched_count"] == 10 and "{'malformed': 1}" in caplog.text
    kept = spark.read.parquet(f"{conf.root}/lookup/run=2024-05-10/malformed")
    assert [(r.page, r.body) for r in kept.collect()] == [(2, "<html>busy</html>")]
    second = run_incremental(spark, conf, table, ask_function(all_answered, 2), FRIDAY)
    assert second.report.sections["process"]["matched_count"] == 10 and second.lookup.pages == 1
    assert second.report.additional_info is None
    third = run_incremental(spark, conf, table, ask_function(html, 2), FRIDAY)
    assert third.report.sections["process"]["new_count"] == 0 and third.lookup.pages == 0


@pytest.mark.parametrize("lost_in", ["upsert", "append"])
def test_a_run_with_a_malformed_body_is_repeated_under_its_id(spark, monkeypatch, lost_in):
    table, conf = rows_to_ask(spark), config(spark, page_size=10)

    def lost(self, *args, **named):
        raise RuntimeError("executors lost")

    with monkeypatch.context() as patch:
        patch.setattr(StateTable if lost_in == "upsert" else CacheTable, lost_in, lost)
        failed = run_incremental(spark, conf, table, ask_function(html, 2), FRIDAY, "r1", raise_errors=False)
        assert failed.report.additional_info == "executors lost" and failed.output is None
    redone = run_incremental(spark, conf, table, ask_function(all_answered, 2), FRIDAY, "r1")
    # after the delivery only the state is written again; before it, what was not answered is asked for again
    assert redone.report.sections["process"]["matched_count"] == (20 if lost_in == "upsert" else 30)
    assert redone.lookup.malformed == (1 if lost_in == "upsert" else 0)
    last = run_incremental(spark, conf, table, ask_function(all_answered, 2), FRIDAY, "r2")
    assert StateTable(spark, f"{conf.root}/state").read().count() == 30
    assert last.report.sections["process"]["matched_count"] == (10 if lost_in == "upsert" else 0)


def test_waves_that_are_through_are_not_asked_again(spark):
    """A task dies for good in the third wave: the repeat asks for its pages and the later ones only."""
    folder = tempfile.mkdtemp()
    table = day_table(spark, [(i, "a", 1, dt.datetime(2024, 5, 9), "d") for i in range(100)], FRIDAY)
    conf = config(spark, page_size=5, pages_per_wave=4)  # 20 pages, 5 waves

    def asked(attempt, dies):
        def fetch(page, ids):
            with open(f"{folder}/{attempt}", "a") as log:
                log.write("".join(f"{page} {i}\n" for i in ids))
            if dies and page == 10:
                raise OSError("lost")
            return all_answered(page, ids)

        return ask_function(fetch, 2)

    def pages_and_ids(attempt):
        with open(f"{folder}/{attempt}") as log:
            lines = [line.split() for line in log]
        return {int(page) for page, _ in lines}, [i for _, i in lines]

    first = run_incremental(spark, conf, table, asked("first", True), FRIDAY, "r1", raise_errors=False)
    assert first.report.status == "error" and first.lookup.waves == 5 and first.lookup.answered == 8
    pages, before = pages_and_ids("first")
    assert max(pages) <= 12 and pages >= set(range(1, 9))
    second = run_incremental(spark, conf, table, asked("second", False), FRIDAY, "r1")
    _, after = pages_and_ids("second")
    through = set(before) - set(after)
    assert len(through) == 40 and len(after) == len(set(after)) == 60  # waves 1 and 2 are not asked for again
    assert second.report.sections["process"]["matched_count"] == 100
    assert CacheTable(spark, f"{conf.root}/cache").read().count() == 100


def test_a_lost_task_asks_for_its_own_wave_again(spark):
    folder = tempfile.mkdtemp()
    table = day_table(spark, [(i, "a", 1, dt.datetime(2024, 5, 9), "d") for i in range(100)], FRIDAY)

    def fetch(page, ids):
        with open(f"{folder}/{page}", "a") as log:
            log.write("x")
        if page == 10 and not os.path.exists(f"{folder}/died"):
            open(f"{folder}/died", "x").close()
            raise OSError("executor lost")
        return all_answered(page, ids)

    conf = config(spark, page_size=5, pages_per_wave=4)
    result = run_incremental(spark, conf, table, ask_function(fetch, 2), FRIDAY, "r1")
    calls = {page: os.path.getsize(f"{folder}/{page}") for page in range(1, 21)}
    assert all(calls[page] == 1 for page in calls if not 9 <= page <= 12) and calls[10] == 2
    assert result.output.count() == 100 and result.lookup.answered == 20


def test_many_waves_are_sent_by_a_bounded_number_of_jobs(spark):
    table = day_table(spark, [(i, "a", 1, dt.datetime(2024, 5, 9), "d") for i in range(100)], FRIDAY)
    sound, sent = ask_function(all_answered, 2), []

    def ask(pages):
        sent.append(sorted(r["page"] for r in pages.collect()))
        return sound(pages)

    conf = config(spark, page_size=5, pages_per_wave=1)
    result = run_incremental(spark, conf, table, ask, FRIDAY, "r1")
    assert result.lookup.waves == result.lookup.pages == result.lookup.answered == 20
    assert sorted(page for pages in sent for page in pages) == list(range(1, 21))
    assert len(sent) == 10 and result.output.count() == 100


def test_a_repeat_goes_on_at_the_step_that_failed(spark, golden, monkeypatch):
    """After the rows are staged the raw table is not read again, after the delivery nothing is looked up."""

    def unread(text):
        raise OSError("the raw table was read")

    def gone(page, ids):
        raise OSError("no service")

    conf = config(spark)
    broken = golden.withColumn("description", F.udf(unread, "string")("description"))
    first = run_incremental(spark, conf, golden, ask_function(gone, 1), FRIDAY, "r1", raise_errors=False)
    assert first.report.status == "error" and first.report.sections["cleanup"]["status"] == "success"
    with monkeypatch.context() as patch:
        patch.setattr(StateTable, "upsert", lambda self, *args, **named: 1 / 0)
        ask = ask_table(service(spark, [123456789, 987654321]))
        second = run_incremental(spark, conf, broken, ask, FRIDAY, "r1", raise_errors=False)
    assert second.report.additional_info == "division by zero"
    third = run_incremental(spark, conf, broken, ask_function(gone, 1), FRIDAY, "r1")
    expected = run_incremental(spark, config(spark), golden, ask, FRIDAY, "r1")
    assert third.report.sections == second.report.sections | {"persist": expected.report.sections["persist"]}
    assert third.report.sections == expected.report.sections and third.lookup == expected.lookup
    assert rows(third.output) == rows(expected.output)
    assert not os.path.exists(f"{conf.root}/staged/run=r1") and not os.path.exists(f"{conf.root}/steps/run=r1")


def test_a_repeat_on_another_basis_starts_anew(spark, golden):
    """Another run has changed the state since the rows were staged: they are compared with it again."""

    def gone(page, ids):
        raise OSError("no service")

    conf = config(spark)
    run_incremental(spark, conf, golden, ask_function(gone, 1), FRIDAY, "r1", raise_errors=False)
    ask = ask_table(service(spark, [123456789, 987654321]))
    assert run_incremental(spark, conf, golden, ask, FRIDAY, "r2").report.sections["process"]["new_count"] == 2
    again = run_incremental(spark, conf, golden, ask, FRIDAY, "r1")
    assert again.report.sections["process"]["new_count"] == 0 and again.output.isEmpty()


def test_the_secret_is_not_shown(spark):
    assert "unique" not in repr(config(spark))


def test_many_tasks_write_the_pages_of_a_wave(spark):
    """Joined or asked for by the tasks that read them, a wave's pages are not all in one file."""
    folder = new_folder(spark, "lookup")
    ids = spark.range(1500).select(F.col("id").cast("string").alias("id"))
    service = ids.withColumn("uuid", F.concat(F.lit("u"), "id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one partition
    try:
        answers = lookup_enrich(ids, CacheTable(spark, f"{folder}/cache"), ask_table(service), "r1", folder, page_size=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {r[0] for r in spark.read.parquet(f"{folder}/pages").select(F.input_file_name()).distinct().collect()}
    assert len(files) > 1 and all("sending=0" in f for f in files)
    assert rows(answers.select("id", "uuid")) == rows(service)
