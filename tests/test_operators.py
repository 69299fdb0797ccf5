from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.functions import row_fingerprint
from tests.conftest import rows

KEYS = ("id", "code")


def raw(spark, data):
    return spark.createDataFrame(data, "id string, code string, at int, tie int, description string")


def random_rows(seed, n=400):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["1", "2", "3", None]),
            rng.choice(["a", "b", None]),
            rng.choice([1, 2, 3, None]),
            rng.randrange(3),
            rng.choice(["x", None]),
        )
        for _ in range(n)
    ]


def test_dedup_prefers_newest_then_tie_break_and_nulls_last(spark):
    df = raw(
        spark,
        [("1", "a", 1, 9, "old"), ("1", "a", 2, 1, "low"), ("1", "a", 2, 2, "high"), ("2", "a", None, 1, "null"), ("2", "a", 0, 1, "zero")],
    )
    kept = op.dedup_latest(df, KEYS, ["at", "tie"])
    assert rows(kept.select("id", "description")) == [("1", "high"), ("2", "zero")]


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_dedup_parts_make_the_whole(spark, chunk):
    data = random_rows(chunk)
    df = raw(spark, data)
    kept = [tuple(r) for r in op.dedup_latest(df, KEYS, ["at", "tie"]).collect()]
    dropped = [tuple(r) for r in op.dedup_discarded(df, KEYS, ["at", "tie"], chunk).collect()]
    assert Counter(kept) + Counter(dropped) == Counter(data)
    assert len({r[:2] for r in kept}) == len(kept) == len({r[:2] for r in data})
    def rank(r):
        return [(v is not None, v) for v in (r[2], r[3], r[4])]

    for r in kept:
        assert all(rank(r) >= rank(o) for o in data if o[:2] == r[:2])


def test_dedup_discarded_of_one_hot_key(spark):
    df = spark.range(5000).select(
        F.lit("1").alias("id"), F.lit("a").alias("code"), F.lit(1).alias("at"), (F.col("id") % 2).alias("tie")
    )
    discarded = op.dedup_discarded(df, KEYS, ["at", "tie"], chunk=100)
    assert {r.tie: r["count"] for r in discarded.groupBy("tie").count().collect()} == {0: 2500, 1: 2499}


def test_ties_on_maps(spark):
    """Equal keys and times: what is kept depends on no row order and no order of a map's entries."""
    data = [("1", 5, {"b": 1, "a": 2}, [{"x": 1}], '{"k": [1, 2]}'), ("1", 5, {"a": 2, "b": 3}, [{"x": 1}], '{"k": 1}')]
    data += [("2", 5, {"a": 1}, [{"x": 1}, {"y": 2}], None), ("2", 5, {"a": 1}, [{"x": 2}], None), ("2", 5, None, None, None)]
    data += [("3", 5, {"a": 1}, [], '{"b": 1, "a": 1}'), ("3", 5, {"a": 1}, [], '{"a": 2}')]
    df = spark.createDataFrame(data, "id string, at int, m map<string,int>, l array<map<string,int>>, v string").withColumn("v", F.parse_json("v"))
    kept = {r.id: (r.m, r.l, str(r.v)) for r in op.dedup_latest(df, ["id"], ["at"]).collect()}
    for seed in range(4):
        shuffled = df.orderBy(F.rand(seed)).repartition(3)
        assert {r.id: (r.m, r.l, str(r.v)) for r in op.dedup_latest(shuffled, ["id"], ["at"]).collect()} == kept
    assert kept["1"][0] == {"a": 2, "b": 3} and kept["2"][1] == [{"x": 2}] and kept["3"][2] == '{"a":2}'


def test_retried_tasks_keep_the_same_row_of_a_tie_on_maps(spark, tmp_path):
    @F.udf("map<string,int>")
    def flaky(key, n):
        mark = tmp_path / f"{key % 3}"
        if n == 7 and not mark.exists():
            mark.touch()
            raise OSError("lost")
        return dict(sorted({"a": n, "b": -n}.items(), reverse=not mark.exists()))

    df = spark.range(600, numPartitions=4).select((F.col("id") % 30).alias("key"), (F.col("id") % 20).cast("int").alias("n"))
    kept = op.dedup_latest(df.select("key", flaky("key", "n").alias("m")), ["key"], [])
    assert {r.key: r.m["a"] for r in kept.collect()} == {k: max(n % 20 for n in range(600) if n % 30 == k) for k in range(30)}


def test_required_columns(spark):
    df = raw(spark, [("1", "a", 1, 1, "x"), ("2", None, 1, 1, "x"), ("3", "a", 1, 1, None)])
    assert [r[0] for r in rows(op.require_description(df).select("id"))] == ["1", "2"]
    assert [r[0] for r in rows(op.require_code(df).select("id"))] == ["1", "3"]


def sha(df):
    return df.select(*KEYS, row_fingerprint("code", "id", "group_id").alias("sha2"))


def test_change_detect(spark):
    schema = "id string, code string, group_id long"
    state = sha(spark.createDataFrame([("1", "a", 1), ("2", "a", 1), ("3", "a", 1)], schema))
    batch = spark.createDataFrame([("1", "a", 1), ("2", "a", 2), ("4", "a", 1), (None, "a", 1)], schema)
    tagged = op.change_detect(batch, state, KEYS, ["code", "id", "group_id"])
    assert rows(tagged.select("id", "change")) == [
        (None, "new"),
        ("1", "repeated"),
        ("2", "changed"),
        ("4", "new"),
    ]
    assert sorted(r.id or "" for r in op.rows_to_save(tagged).collect()) == ["", "2", "4"]


def test_shared_code_unchanged_is_repeated(spark):
    batch = spark.createDataFrame([("1", "a", 1), ("2", "a", 1)], "id string, code string, group_id long")
    tagged = op.change_detect(batch, sha(batch), KEYS, ["code", "id", "group_id"])
    assert [r.change for r in tagged.collect()] == ["repeated", "repeated"]
    by_code = op.change_detect_by_code(batch, sha(batch), ["code", "id", "group_id"])
    assert rows(by_code.select("id", "state", "copies")) == [
        ("1", "save", 1),
        ("1", "skip", 1),
        ("2", "save", 1),
        ("2", "skip", 1),
    ]


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_change_detect_by_code_counts_the_pairs(spark, hot_rows):
    rng = random.Random(3)
    schema = "id string, code string, group_id long"

    def table(n):
        return spark.createDataFrame(
            [(str(rng.randrange(30)), rng.choice("aaabcd"), rng.randrange(2)) for _ in range(n)], schema
        ).distinct()

    batch, state = table(80).cache(), sha(table(80)).cache()
    counted = op.change_detect_by_code(batch, state, ["code", "id", "group_id"], hot_rows=hot_rows)
    new, old = [tuple(r) for r in sha(batch).collect()], [tuple(r) for r in state.collect()]
    pairs = Counter()
    for i, code, h in new:
        same_code = [o for o in old if o[1] == code]
        for o in same_code or [None]:
            pairs[i, code, h, "skip" if o and o[2] == h else "save"] += 1
    got = Counter()
    for r in counted.collect():
        got[r.id, r.code, r.sha2, r.state] += r.copies
    assert got == pairs


def test_state_upsert_two_codes_per_id(spark):
    schema = "id string, code string, sha2 string"
    state = spark.createDataFrame([("1", "a", "old"), ("1", "b", "old"), ("2", "a", "kept")], schema)
    batch = spark.createDataFrame([("1", "a", "new"), ("1", "b", "new"), ("3", "a", "new")], schema)
    merged = op.state_upsert(state, batch, KEYS)
    assert rows(merged) == [("1", "a", "new"), ("1", "b", "new"), ("2", "a", "kept"), ("3", "a", "new")]


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_state_upsert_by_id_counts_the_pairs(spark, hot_rows):
    schema = "id string, code string, sha2 string"
    state = spark.createDataFrame([("1", "a", "old"), ("1", "b", "old"), ("2", "a", "kept"), (None, "a", "kept")], schema)
    batch = spark.createDataFrame([("1", "a", "new"), ("1", "b", "new"), ("3", "a", "new"), (None, "a", "new")], schema)
    assert rows(op.state_upsert_by_id(state, batch, hot_rows=hot_rows)) == [
        (None, "a", "kept", 1),
        (None, "a", "new", 1),
        ("1", "a", "new", 2),
        ("1", "b", "new", 2),
        ("2", "a", "kept", 1),
        ("3", "a", "new", 1),
    ]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("hot_rows", [1, 20, 60, 1_000_000])
def test_lookup_join_equals_join(spark, how, hot_rows):
    left = spark.createDataFrame(
        [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 17}", i) for i in range(200)], "id string, n int"
    )
    right = spark.createDataFrame([("hot", "H"), ("k1", "1"), ("k2", "2"), ("only", "o"), (None, "x")], "id string, v string")
    assert rows(op.lookup_join(left, right, "id", how, hot_rows)) == rows(left.join(right, "id", how))


def jobs_of(spark, make):
    """The jobs that run while ``make`` builds its plan."""
    spark.sparkContext.setJobGroup("built", "plans being built")
    try:
        make()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup("built"))
    finally:
        spark.sparkContext.setJobGroup("other", "all else")


def test_building_a_skewed_join_starts_no_job(spark):
    schema = "id string, code string, sha2 string"
    state = spark.createDataFrame([("1", "a", "x")], schema)
    batch = spark.createDataFrame([("1", "a"), ("2", "a")], "id string, code string")
    known = cache(spark, [("u", "1", "r_1")])
    assert not jobs_of(spark, lambda: op.change_detect_by_code(batch, state, ["id", "code"]))
    assert not jobs_of(spark, lambda: op.enrich_tagged(batch, known))
    assert not jobs_of(spark, lambda: op.state_upsert_by_id(state, state))
    assert len(jobs_of(spark, lambda: op.enrich_tagged(batch, known).collect())) > 0


def test_rows_without_a_key_are_not_shuffled(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 100, F.col("id").cast("string")).alias("id"))
    right = spark.createDataFrame([("5", "x"), (None, "never")], "id string, v string")
    joined = op.lookup_join(left, right, "id", "left", 500)
    assert joined.count() == 1000 and joined.where("v is not null").count() == 1
    assert op.hot_keys(left, "id", 500).isEmpty()  # null is no key
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 2


def test_any_number_of_hot_keys(spark):
    left = spark.range(6000).select((F.col("id") % 1500).cast("string").alias("id"))
    assert op.hot_keys(left, "id", 4).count() == 1500


def test_hot_is_relative_to_the_table(spark, monkeypatch):
    from tidemark.operators import skew

    monkeypatch.setattr(skew, "FEWEST_HOT_ROWS", 10)
    half_a_partition = 4000 // (2 * 4)  # four shuffle partitions
    left = spark.createDataFrame([("a",)] * half_a_partition + [("b",)] * (half_a_partition - 1) + [(str(i),) for i in range(4000 - 2 * half_a_partition + 1)], "id string")
    assert rows(op.hot_keys(left, "id")) == [("a",)]


def test_hot_keys(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)] * 4 + [("c",)], "id string")
    assert rows(op.hot_keys(df, "id", 3)) == [("a",), ("b",)]
    assert op.hot_keys(df, "id", 6).isEmpty()


def cache(spark, data):
    return spark.createDataFrame(data, "uuid string, id string, partition_ref string")


def test_latest_answers(spark):
    schema = "uuid string, id string, partition_ref string, version long, page long"
    data = [
        ("old", "1", "run9_9", 9, 9),
        ("two", "1", "run10_2", 10, 2),
        ("ten", "1", "run10_10", 10, 10),
        ("x", "2", "run1_1", 1, 1),
        (None, "2", "run2_1", 2, 1),
    ]
    got = op.latest_answers(spark.createDataFrame(data, schema))
    assert rows(got) == [(None, "2", "run2_1"), ("ten", "1", "run10_10")]
    assert rows(op.latest_answers(cache(spark, [("a", "1", "r_1"), ("b", "1", "r_2")]))) == [("b", "1", "r_2")]


def test_known_answers(spark):
    ids = spark.createDataFrame([("1",), ("3",), ("4",)], "id string")
    df = cache(spark, [("a", "1", "r1_1"), ("b", "1", "r2_1"), ("c", "2", "r1_1"), (None, "4", "r1_1")])
    assert rows(op.known_answers(ids, df)) == [(None, "3", None), (None, "4", "r1_1"), ("b", "1", "r2_1")]


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_enrich(spark, hot_rows):
    batch = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), (None, "a"), ("3", "a")], "id string, code string")
    known = cache(spark, [("u1", "1", "r_1"), ("u1b", "1", "r_2"), ("u9", "9", "r_1"), (None, "3", "r_1")])
    tagged = op.enrich_tagged(batch, known, hot_rows=hot_rows)
    assert rows(tagged.select("id", "code", "uuid", "state")) == [
        (None, "a", None, "skipped"),
        ("1", "a", "u1b", "save"),
        ("1", "b", "u1b", "save"),
        ("2", "a", None, "skipped"),
        ("3", "a", None, "skipped"),
    ]
    assert rows(op.enrich_matched(batch, known, hot_rows=hot_rows).select("id", "code")) == [("1", "a"), ("1", "b")]
    assert rows(op.enrich_unmatched(batch, known, hot_rows=hot_rows)) == [(None, "a"), ("2", "a"), ("3", "a")]


def test_enrich_full_outer_is_a_full_join(spark):
    batch = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), (None, "a")], "id string, code string")
    known = cache(spark, [("u1", "1", "r_1"), ("u1", "1", "r_1"), ("u2", "1", "r_2"), (None, "2", "r_1"), (None, "9", "r_1"), ("u8", "8", "r_1"), ("u0", None, "r_1")])
    got = op.enrich_full_outer(batch, known)
    pairs = batch.join(known, "id", "full_outer").withColumn("state", F.when(F.col("uuid").isNull(), "skipped").otherwise("save"))
    assert rows(got.where("copies > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "col")) == rows(pairs)
    assert got.columns == ["id", "code", "uuid", "partition_ref", "state", "copies"]


def test_other_key_name(spark):
    batch = spark.createDataFrame([("1",), ("2",)], "doc string")
    known = cache(spark, [("u1", "1", "r_1")])
    assert rows(op.enrich_matched(batch, known, "doc").select("doc", "uuid")) == [("1", "u1")]
    assert rows(op.unseen_keys(batch, known, "doc")) == [("2",)]


def test_unmatched_sample(spark):
    df = spark.range(100).select(F.format_string("%03d", "id").alias("id"))
    assert [r.id for r in op.unmatched_sample(df, 3).collect()] == ["000", "001", "002"]


def test_unseen_keys_are_distinct_and_null_passes(spark):
    batch = spark.createDataFrame([("1",), ("2",), ("2",), (None,), ("abc",)], "id string")
    assert rows(op.unseen_keys(batch, cache(spark, [("u", "1", "r_1")] * 3))) == [(None,), ("2",), ("abc",)]


@pytest.mark.parametrize("n, pages", [(0, 0), (1, 1), (499, 1), (500, 2), (998, 2), (2500, 6)])
def test_exact_pages(spark, n, pages):
    keys = spark.range(n).select(F.col("id").cast("string").alias("id"))
    paged = op.assign_pages(keys)
    sizes = {r.page: r["count"] for r in paged.groupBy("page").count().collect()}
    assert sorted(sizes) == list(range(1, pages + 1))
    assert sum(sizes.values()) == n == paged.select("id").distinct().count()
    assert all(sizes[p] == 499 for p in sizes if p < pages)


def test_pages_do_not_depend_on_partitioning(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    assert rows(op.assign_pages(keys.repartition(7), bucket_digits=1)) == rows(
        op.assign_pages(keys.coalesce(1), bucket_digits=1)
    )


def answering(page, ids):
    if page == 2:
        return 204, None
    if page == 3:
        return 500, '{"error": "no"}'
    return 200, json.dumps([{"id": int(i), "uuid": f"u{i}"} for i in ids + ids])


def test_ask_function_and_statuses(spark):
    keys = spark.range(25).select(F.col("id").cast("string").alias("id"))
    paged = op.assign_pages(keys, page_size=10)
    responses = op.ask_function(answering, 3)(op.lookup_pages(paged))
    assert [(r.page, r.status) for r in responses.orderBy("page").collect()] == [(1, 200), (2, 204), (3, 500)]
    parsed = op.parse_responses(responses, "2024-05-13")
    asked = {r.id for r in paged.where("page = 1").collect()}
    assert rows(parsed) == sorted((f"u{i}", i, "2024-05-13_1") for i in asked)


def test_answers_without_uuid_are_kept_and_without_id_counted(spark):
    body = '[{"id": 1, "uuid": "u1"}, {"id": 2}, {"uuid": "u3"}, {"id": 2, "uuid": null}]'
    responses = spark.createDataFrame([(1, 200, body), (2, 204, None)], "page long, status int, body string")
    assert rows(op.parse_responses(responses, "r")) == [(None, "2", "r_1"), ("u1", "1", "r_1")]
    assert [r[0] for r in responses.orderBy("page").select(op.items_without_id()).collect()] == [1, 0]


def test_bucket_digits_are_bounded(spark):
    with pytest.raises(ValueError, match="digits"):
        op.assign_pages(spark.createDataFrame([("1",)], "id string"), bucket_digits=7)


BODIES = {  # what each body of a status 200 is
    '[{"id": 1, "uuid": "u"}]': "answered",
    " [ ] ": "answered",
    '[null, {"id": 2}]': "answered",
    "<html>busy</html>": "malformed",
    "": "malformed",
    None: "malformed",
    "null": "malformed",
    "5": "malformed",
    '{"id": 1, "uuid": "u"}': "malformed",
    "[1, 2]": "malformed",
    '[{"id": 1}, 3]': "malformed",
    '[{"id": 1}': "malformed",
    '[{"id": 1},]': "malformed",
}


def test_bodies_that_cannot_be_read(spark):
    data = [(page, 200, body) for page, body in enumerate(BODIES)] + [(100, 204, None), (101, 503, '[{"id": 9, "uuid": "u"}]'), (102, 404, "<html>")]
    responses = spark.createDataFrame(data, "page long, status int, body string")
    got = [r[0] for r in responses.orderBy("page").select(op.page_outcome()).collect()]
    assert got == [*BODIES.values(), "empty", "failed", "failed"]
    assert rows(op.parse_responses(responses, "r")) == [(None, "2", "r_2"), ("u", "1", "r_0")]
    bad = {(page, body) for page, (body, kind) in enumerate(BODIES.items()) if kind == "malformed"}
    assert {tuple(r) for r in op.malformed_pages(responses).collect()} == bad


def test_waves(spark):
    pages = spark.range(1, 11).select(F.col("id").alias("page"))
    assert rows(op.page_waves(pages, 4).groupBy("wave").count()) == [(0, 4), (1, 4), (2, 2)]


def test_ask_table(spark):
    service = spark.createDataFrame([("1", "u1"), ("1", "u1"), ("2", "u2")], "id string, uuid string")
    pages = spark.createDataFrame([(1, ["1", "2", "3"]), (2, ["4"])], "page long, ids array<string>")
    responses = op.ask_table(service)(pages)
    assert [(r.page, r.status) for r in responses.orderBy("page").collect()] == [(1, 200), (2, 204)]
    assert rows(op.parse_responses(responses, "r")) == [("u1", "1", "r_1"), ("u2", "2", "r_1")]


def test_a_body_is_parsed_once(spark):
    bodies = [(1, 200, '[{"uuid": "u", "id": "a"}, {"uuid": "u", "id": "a"}, {"uuid": "v"}]'), (2, 503, '[{"uuid": "u", "id": "b"}]'), (3, 200, "<html>")]
    responses = spark.createDataFrame([*bodies, (4, 200, None), (5, None, "[]")], "page long, status int, body string")
    parsed = op.parse_responses(responses, "run")
    assert rows(parsed) == [("u", "a", "run_1")]
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
