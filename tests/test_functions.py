from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    derive_entity_id,
    keyed_uuid,
    partition_predicate_text,
    register_keyed_uuid,
    row_fingerprint,
    workday_anchor,
)

SECRET = b"my-unique-secret"


def expected_uuid(text, secret=SECRET):
    digest = hmac.new(secret, str(text).encode(), hashlib.sha256).digest()
    return str(uuid.UUID(bytes=digest[:16], version=4))


def column(df, name):
    return [row[name] for row in df.collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(codec="utf-8"), max_size=60), min_size=1, max_size=50), secret=st.binary(max_size=100))
def test_keyed_uuid_equals_hmac(spark, texts, secret):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert column(df.select(keyed_uuid("text", secret).alias("u")), "u") == [expected_uuid(t, secret) for t in texts]


def test_keyed_uuid_of_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "text string").select(keyed_uuid("text", SECRET).alias("u"))
    assert column(df, "u") == [expected_uuid(None), "02e33f9a-c696-4efe-99c1-3f72da5f878f"]


def test_keyed_uuid_from_sql(spark):
    register_keyed_uuid(spark, SECRET)
    df = spark.sql("SELECT deterministic_uuid(v) AS u FROM VALUES ('a'), (null), ('ü||x') AS t(v)")
    assert column(df, "u") == [expected_uuid(t) for t in ("a", None, "ü||x")]


def test_no_python_in_uuid_plan(spark):
    df = spark.range(10).select(keyed_uuid(F.col("id").cast("string"), SECRET).alias("u"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.lstrip().startswith("*")


def test_golden_fingerprint_and_ids(spark):
    df = spark.createDataFrame(
        [("abcde12345", 123456789, 2), ("abcde12345", 987654321, 2)], "code string, id long, group_id long"
    )
    lookup = keyed_uuid(F.col("id").cast("string"), SECRET)
    out = df.select(
        row_fingerprint("code", "id", "group_id").alias("sha2"),
        lookup.alias("lookup"),
        derive_entity_id(lookup, "code", SECRET).alias("entity"),
    )
    assert [tuple(r) for r in out.collect()] == [
        (
            "f3eeaba753707898074257689d058003889a7d9c4b224905304e75ec5c18a006",
            "340e3456-e569-4b65-ad00-6449a6bf4da0",
            "1bb1512f-8e33-4207-8167-4d3c0bcf85b9",
        ),
        (
            "fca19938d17fe12b7f5041b228175785b61b77be3f818532789fa72e3056101a",
            "d68134fe-6d0c-4c26-83c0-bd9c1dd01ab8",
            "81b4c2a0-5478-4fcb-80d8-e3645341baf0",
        ),
    ]


def test_null_token_separates_shifted_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = column(df.select(row_fingerprint("x", "y", "z").alias("h")), "h")
    marked = column(df.select(row_fingerprint("x", "y", "z", null_token="~").alias("h")), "h")
    assert plain[0] == plain[1] and marked[0] != marked[1]


@pytest.mark.parametrize("day, anchor", [(10, 10), (11, 10), (12, 10), (13, 13)])
def test_workday_anchor(spark, day, anchor):
    row = spark.range(1).select(workday_anchor(F.lit(dt.date(2024, 5, day))).alias("a")).first()
    assert row.a == dt.date(2024, 5, anchor)


def test_predicate_text(spark):
    row = spark.range(1).select(partition_predicate_text(F.lit(dt.date(2024, 5, 9))).alias("p")).first()
    assert row.p == "year=2024 and month=05 and day=09"
