"""Every registered query against its SQL, and what holds between them."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA
from workload.queries import QUERIES

SF_DIR = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_each_query_has_its_sql():
    assert QUERIES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    got = driver.queries()[name](spark, str(SF_DIR)).toArrow()
    expected = tables.sql(driver.oracle_sql()[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(got.column_names) == columns

    def multiset(table):
        return Counter(zip(*(table[c].to_pylist() for c in columns)))

    assert multiset(got) == multiset(expected)
    assert expected.num_rows > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_report_identities(spark):
    def section(df, name):
        return {r.name: int(r.value) for r in df.where(f"section = '{name}' and name <> 'status'").collect()}

    report = driver.queries()["run_report"](spark, str(SF_DIR)).cache()
    c, p, out = (section(report, s) for s in ("cleanup", "process", "persist"))
    assert c["raw_count"] == c["duplicated_count"] + c["de_duplicated_count"]
    assert c["de_duplicated_count"] == c["no_description"] + c["description_count"]
    assert c["description_count"] == c["no_code_count"] + c["code_count"]
    assert c["valid_rows"] == c["code_count"] == p["raw_count"]
    assert p["raw_count"] == p["new_count"] + p["repeated_count"]
    assert p["new_count"] == p["matched_count"] + p["not_matched_count"]
    assert p["matched_count"] == p["transformed_count"] == p["valid_rows"]
    assert out["raw_count"] == out["valid_rows"] == p["valid_rows"]
