from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas, sources
from tidemark.sources import CacheTable, StateTable, VersionedTable, new_folder

FRIDAY = dt.date(2024, 5, 10)


def days(spark, *dates):
    return spark.createDataFrame([(str(d.year), str(d.month), str(d.day)) for d in dates], "year string, month string, day string")


def test_recent_and_latest(spark):
    listing = days(spark, dt.date(2024, 5, 10), dt.date(2024, 5, 9), dt.date(2024, 5, 8), dt.date(2024, 5, 20))
    recent = sources.recent_partitions(listing, FRIDAY)
    assert rows(recent) == [("2024", "5", "10"), ("2024", "5", "20"), ("2024", "5", "9")]
    bounded = sources.recent_partitions(listing, FRIDAY, until=FRIDAY)
    newest = sources.latest_partition(bounded, FRIDAY).first()
    assert (newest.date_ref, newest.predicate) == (FRIDAY, "year=2024 and month=05 and day=10")


def test_no_recent_partition_falls_back_to_anchor(spark):
    sunday = dt.date(2024, 5, 12)
    recent = sources.recent_partitions(days(spark, dt.date(2024, 1, 1)), sunday)
    assert sources.latest_partition(recent, sunday).first().date_ref == FRIDAY


@pytest.fixture
def partitioned(spark):
    path = new_folder(spark, "days")
    spark.range(30).select("id", F.lit(2024).alias("year"), F.lit(5).alias("month"), (F.col("id") % 3 + 8).alias("day")).write.partitionBy("year", "month", "day").parquet(path)
    return path


def test_scan_prunes_partitions(spark, partitioned):
    table = spark.read.parquet(partitioned)
    scan, date, text = sources.latest_partition_scan(table, FRIDAY)
    assert (date, text, scan.count()) == (FRIDAY, "year=2024 and month=05 and day=10", 10)
    for df in (scan, sources.recent_partitions(table, FRIDAY)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_listing_from_catalog(spark, partitioned):
    spark.sql(f"CREATE TABLE day_table (id LONG, year INT, month INT, day INT) USING parquet PARTITIONED BY (year, month, day) LOCATION '{partitioned}'")
    spark.sql("MSCK REPAIR TABLE day_table")
    listing = sources.list_partitions(spark, "day_table")
    assert rows(listing) == [(2024, 5, 10), (2024, 5, 8), (2024, 5, 9)]
    scan, date, _ = sources.latest_partition_scan(spark.table("day_table"), FRIDAY, partitions=listing)
    assert date == FRIDAY and scan.count() == 10
    spark.sql("DROP TABLE day_table")


def batch(spark, n, sha):
    code = F.format_string("c%d", F.col("id") % 3)
    return spark.range(n).select(F.col("id").cast("string").alias("id"), code.alias("code"), F.lit(sha).alias("sha2"))


def test_state_versions(spark):
    table = StateTable(spark, new_folder(spark, "state"), buckets=4)
    assert table.read().schema == schemas.state_schema(("id", "code")) and table.read().isEmpty()
    for version, n in enumerate([10, 4, 3, 2, 12, 1]):
        before = rows(table.read())
        assert table.upsert(batch(spark, n, f"v{version}"), f"run{version}") == version
        expected = {k[:2]: k for k in before} | {(str(i), f"c{i % 3}"): (str(i), f"c{i % 3}", f"v{version}") for i in range(n)}
        assert rows(table.read()) == sorted(expected.values())
    assert table.is_committed("run3") and not table.is_committed("run9")


def test_uncommitted_rows_are_not_read(spark):
    state = StateTable(spark, new_folder(spark, "state"), buckets=2)
    state.upsert(batch(spark, 3, "good"), "run0")
    last = state.table.latest_commit()
    state.table._write(batch(spark, 9, "lost").withColumn("version", F.lit(1).cast("long")), last.generation, 2, "lost")
    assert {r.sha2 for r in state.read().collect()} == {"good"}
    state.upsert(batch(spark, 1, "next"), "run1")
    assert sorted(r.sha2 for r in state.read().collect()) == ["good", "good", "next"]


def test_of_two_writers_the_second_fails(spark):
    path = new_folder(spark, "state")
    StateTable(spark, path, buckets=2).upsert(batch(spark, 3, "x"), "run0")
    slow = StateTable(spark, path, buckets=2)
    write, others = VersionedTable._write, ["fast"]

    def overtaken(self, *args):
        written = write(self, *args)
        if others:
            StateTable(spark, path, buckets=2).upsert(batch(spark, 4, "fast"), others.pop())
        return written

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "_write", overtaken)
        with pytest.raises(ValueError, match="another run has committed"):
            slow.upsert(batch(spark, 9, "slow"), "slow")
    assert {r.sha2 for r in slow.read().collect()} == {"fast"} and not slow.is_committed("slow")


def test_reading_writes_nothing(spark):
    path = new_folder(spark, "state")
    assert StateTable(spark, path).read().isEmpty() and CacheTable(spark, path).read().isEmpty()
    assert not StateTable(spark, path).is_committed("run0")
    assert not os.path.exists(path)


def test_another_session_reads_the_state(spark):
    state = StateTable(spark, new_folder(spark, "state's"), buckets=2)
    state.upsert(batch(spark, 5, "x"), "run0")
    state.table.forget()  # as if this catalog had never seen it
    assert state.read().count() == 5


def test_buckets_fit_the_rows_and_not_the_session(spark, monkeypatch):
    from tidemark.sources import versioned_table

    monkeypatch.setattr(versioned_table, "ROWS_PER_BUCKET", 10)
    state = StateTable(spark, new_folder(spark, "state"))
    buckets = []
    for number, n in enumerate([5, 100, 3, 3, 400, 1]):
        state.upsert(batch(spark, n, f"v{number}"), f"run{number}")
        buckets.append(state.commits()[-1].buckets)
    # the second write would fill one bucket, the last commit finds that the added rows outnumber the base
    assert buckets == [1, 16, 16, 16, 16, 64]
    assert state.read().count() == 400


def test_buckets_by_rows():
    from tidemark.sources.versioned_table import buckets_for

    assert [buckets_for(n) for n in (0, 1, 10**6, 10**6 + 1, 50 * 10**6, 10**10)] == [1, 1, 1, 2, 64, 16384]


def test_the_first_commit_has_buckets_for_its_rows(spark, monkeypatch):
    """Whatever the session's shuffle partitions: by the rows that were staged, or by what the writer says."""
    from tidemark.sources import versioned_table

    monkeypatch.setattr(versioned_table, "ROWS_PER_BUCKET", 10)
    staged = StateTable(spark, new_folder(spark, "state"))
    staged.upsert(batch(spark, 500, "x"), "run0")
    told = StateTable(spark, new_folder(spark, "state"))
    told.upsert(batch(spark, 500, "x"), "run0", about=50_000_000 // 100_000)
    for state in (staged, told):
        assert state.commits()[0].buckets == 64
        files = {path.rsplit("_", 1)[1] for path in state.read().inputFiles()}  # the bucket ends the name
        assert len(files) > 32 and max(files) < "00064"
        assert state.read().count() == 500 and not sources.files.names(spark, f"{state.path}/staged")


def test_files_of_other_writes_are_not_listed(spark):
    state = StateTable(spark, new_folder(spark, "state"), buckets=2)
    for number in range(3):
        state.upsert(batch(spark, 100, f"v{number}"), f"run{number}")
    last = state.table.latest_commit()
    for number in range(5):  # runs that failed before their commit
        state.table._write(batch(spark, 90, "lost").withColumn("version", F.lit(3).cast("long")), last.generation, 2, f"lost{number}")
    assert sum(name.startswith("_write=") for name in os.listdir(f"{state.path}/rows/{last.generation}")) == len(last.writes) + 5
    scan = state.table.rows()
    assert {path.split("_write=")[1].split("/")[0] for path in scan.inputFiles()} <= {w for w in last.writes} | {f"lost{n}" for n in range(5)}
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert f"InMemoryFileIndex({len(last.writes)} paths)" in plan and "_write" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.sha2 for r in state.read().collect()} == {"v2"}
    state.table.forget()  # a catalog that has never seen the failed writes
    assert {path.split("_write=")[1].split("/")[0] for path in state.table.rows().inputFiles()} == set(last.writes)


def test_two_generations_stay_on_disk(spark, monkeypatch):
    from tidemark.sources import versioned_table

    monkeypatch.setattr(versioned_table, "MOST_WRITES", 3)
    state = StateTable(spark, new_folder(spark, "state"), buckets=1)
    for number in range(40):
        state.upsert(batch(spark, 30 if number == 0 else 2, f"v{number}"), f"run{number}")
    named = list(dict.fromkeys(c.generation for c in state.commits()))
    assert len(named) > 10 and sources.files.names(spark, f"{state.path}/rows") == sorted(named[-2:])
    assert state.read().count() == 30 and len(state.commits()) == 40


def test_of_two_commits_held_between_look_and_write_one_wins(spark):
    """Both have looked which version comes next before either writes its entry."""
    path, both = new_folder(spark, "state"), threading.Barrier(2)
    StateTable(spark, path, buckets=1).upsert(batch(spark, 3, "x"), "run0")
    commit, outcomes = VersionedTable._commit, {}

    def held(self, *args):
        both.wait(timeout=60)
        commit(self, *args)

    def write(run):
        try:
            outcomes[run] = StateTable(spark, path, buckets=1).upsert(batch(spark, 5, run), run)
        except ValueError as error:
            outcomes[run] = str(error)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", held)
        threads = [threading.Thread(target=write, args=(run,)) for run in ("one", "two")]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    won = [run for run, outcome in outcomes.items() if outcome == 1]
    assert len(won) == 1 and sum("another run has committed" in str(x) for x in outcomes.values()) == 1
    state = StateTable(spark, path, buckets=1)
    assert {r.sha2 for r in state.read().collect()} == set(won) and state.is_committed(won[0]) and len(state.commits()) == 2


@pytest.mark.parametrize("by_rename", [False, True])
def test_a_file_is_published_once(spark, monkeypatch, by_rename):
    from tidemark.sources import files

    if by_rename:  # the way of file systems whose rename does not replace
        monkeypatch.setattr(files, "_linked", lambda spark, source, target: files._renamed(spark, source, target, overwrite=False))
    path = f"{new_folder(spark, 'log')}/entry.json"
    assert files.read_text(spark, path) is None
    assert files.publish_once(spark, path, "first é") and not files.publish_once(spark, path, "second")
    assert files.read_text(spark, path) == "first é"
    assert files.names(spark, path.rsplit("/", 1)[0]) == ["entry.json"]
    files.write_text(spark, path, "third")
    assert files.read_text(spark, path) == "third"


def test_a_failed_write_leaves_the_old_output(spark):
    path = new_folder(spark, "out")
    df = spark.range(4).select("id", (F.col("id") % 2).alias("g"))
    sources.publish_output(df, path, ["id", "g"], ["g"])
    fails = df.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sources.publish_output(fails, path, ["id", "g"], ["g"])
    assert rows(spark.read.parquet(path)) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    sources.publish_output(spark.read.parquet(path).where("id > 1"), path, ["id"])  # from the place it writes to
    assert rows(spark.read.parquet(path)) == [(2,), (3,)]
    parent, _, name = path.rpartition("/")
    assert [n for n in os.listdir(parent) if name in n] == [name]


def test_an_output_that_cannot_be_swapped_stays(spark):
    from tidemark.sources import files

    path = new_folder(spark, "out")
    spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="does not exist"):
        files.swap(spark, f"{path}-missing", path)
    assert spark.read.parquet(path).count() == 3


def test_a_run_writes_its_own_rows_only(spark, monkeypatch):
    from tidemark.sources import versioned_table

    monkeypatch.setattr(versioned_table, "MOST_WRITES", 4)
    written = []
    write = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, *args: written.append(write(self, *args)) or written[-1])
    state = StateTable(spark, new_folder(spark, "state"), buckets=2)
    for number in range(6):
        state.upsert(batch(spark, 100 if number == 0 else 2, f"v{number}"), f"run{number}")
    assert written == [100, 2, 2, 2, 100, 2, 2]  # after four commits all is rewritten once, without replaced rows
    assert state.read().count() == 100


def test_empty_batch_adds_nothing(spark):
    state = StateTable(spark, new_folder(spark, "state"), buckets=2)
    state.upsert(batch(spark, 5, "x"), "run0")
    assert state.upsert(batch(spark, 0, "y"), "run1") == 1
    first, second = state.commits()
    assert (second.writes, second.rows) == (first.writes, 5) and state.is_committed("run1")
    assert state.upsert(batch(spark, 6, "z"), "run2") == 2
    assert state.read().count() == 6


def test_sorted_files_spare_the_sort(spark):
    from tidemark.operators import state_upsert

    table = StateTable(spark, new_folder(spark, "state"), buckets=4)
    table.upsert(batch(spark, 100, "x"), "run0")
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", True)
    try:
        merged = state_upsert(table.read(), batch(spark, 10, "z"), ["id", "code"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == 1, plan
        assert merged.count() == 100
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")


@pytest.mark.parametrize("runs", [1, 3])
def test_joins_do_not_shuffle_the_state(spark, runs):
    from tidemark.operators import change_detect, dedup_latest, state_upsert

    table = StateTable(spark, new_folder(spark, "state"), buckets=4)
    for number in range(runs):
        table.upsert(batch(spark, 100 if number == 0 else 9, "x"), f"run{number}")
    new = batch(spark, 50, "y").withColumn("group_id", F.lit(1)).drop("sha2")
    latest = dedup_latest(new, ["id", "code"], ["group_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (
            change_detect(latest, table.read(), ["id", "code"], ["code", "id", "group_id"]),
            state_upsert(table.read(), batch(spark, 50, "y"), ["id", "code"]),
        ):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan
            assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def answers(spark, *data):
    return spark.createDataFrame(data, schemas.CACHE)


def test_cache_keeps_all_answers(spark):
    table = CacheTable(spark, new_folder(spark, "cache"), buckets=2)
    table.append(answers(spark, ("u1", "1", "r1_1"), (None, "3", "r1_2")), "r1")
    table.append(answers(spark, ("u2", "1", "r2_10"), ("u3", "2", "r2_x")), "r2")
    assert rows(table.read()) == [(None, "3", "r1_2", 2, 0), ("u1", "1", "r1_1", 1, 0), ("u2", "1", "r2_10", 10, 1), ("u3", "2", "r2_x", None, 1)]
    assert table.is_committed("r1") and not table.is_committed("r3")


def test_newest_answer_is_told_by_numbers(spark):
    from tidemark.operators import latest_answers

    table = CacheTable(spark, new_folder(spark, "cache"), buckets=2)
    table.append(answers(spark, ("nine", "1", "run9_1"), ("p2", "2", "run9_2"), ("p10", "2", "run9_10")), "run9")
    table.append(answers(spark, ("ten", "1", "run10_1")), "run10")
    assert rows(latest_answers(table.read()).select("id", "uuid")) == [("1", "ten"), ("2", "p10")]


@pytest.mark.parametrize("ids", [3, 50_000])
def test_the_cache_is_not_shuffled(spark, ids):
    from tidemark.operators import known_answers

    table = CacheTable(spark, new_folder(spark, "cache"), buckets=4)
    for run in ("r1", "r2"):
        table.append(spark.range(100).select(F.lit("u").alias("uuid"), F.col("id").cast("string").alias("id"), F.lit(f"{run}_1").alias("partition_ref")), run)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wanted = spark.range(ids).select(F.col("id").cast("string").alias("id"))
        plan = known_answers(wanted, table.read())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Exchange" not in plan[plan.index("Window") :], plan


def test_shared_dir_is_the_configured_one(spark):
    assert sources.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_publish(spark):
    path = new_folder(spark, "out")
    df = spark.createDataFrame([("1", "a", 1)], "id string, code string, g int")
    sources.publish_output(df, path, ["id", "g"], ["g"])
    assert spark.read.parquet(path).columns == ["id", "g"]
    sources.publish_view(df, "published")
    assert rows(sources.scan_view(spark, "published")) == [("1", "a", 1)]


def test_writers_of_one_table_share_no_folder(spark):
    """The first job to end deletes its folder's temporary files, so each has a folder of its own."""
    path = new_folder(spark, "state")
    table = StateTable(spark, path, buckets=1).table
    written, declared = [], []

    def created(self, name, buckets, place, partition=None):
        declared.append((name, place))
        return create(self, name, buckets, place, partition)

    create = VersionedTable._create
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "_create", created)
        for write in ("one", "two"):
            rows = batch(spark, 3, write).withColumn("version", F.lit(0).cast("long"))
            written.append(table._write(rows, "g", 1, write))
    assert written == [3, 3] and len({place for _, place in declared}) == 2
    assert not any(spark.catalog.tableExists(name) for name, _ in declared)
