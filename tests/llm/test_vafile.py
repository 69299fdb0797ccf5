from __future__ import annotations

from collections import Counter
from math import floor, isfinite

import duckdb
import numpy as np
import pytest

from tests.conftest import TESTDATA
from tidemark.llm import vafile
from tidemark.llm.queries import ORACLE, op2_exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score double, cells string, place int, dim int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, "", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k, every):
    usable = [(i, [floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v and all(x is not None and isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(usable):
        if i is not None and i % every == 0:
            best = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for p, (j, w) in enumerate(usable) if p != q and len(w) == len(v)]
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(sorted(best)[:k])]
    return Counter(out)


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(150)]
    rows += [(i, [0.25, -0.5, 1.0, 0.0, 2.0, -1.0]) for i in (200, 201, 202, 202, 210)]  # ties and repeated rows
    rows += [(300, None), (310, []), (320, [1.0, None] * 3), (330, [float("nan")] * 6), (340, [float("inf")] * 6)]
    rows += [(350, [1.0, 2.0]), (351, [3.0, -2.0]), (None, [0.25, -0.5, 1.0, 0.0, 2.0, -1.0])]  # another length, no id
    expected = brute(rows, 5, 10)
    assert Counter(map(tuple, vafile.top_k(table(spark, rows), 5, every=10).collect())) == expected
    monkeypatch.setattr(vafile, "BLOCK", 1)  # many blocks of queries
    assert Counter(map(tuple, vafile.top_k(table(spark, rows).repartition(4), 5, every=10).collect())) == expected


def test_wide_components_take_part(spark, monkeypatch):
    """One or many vectors of large components, as queries and as candidates, beside usual ones."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(1, 60)]
    rows += [(0, [0.5, -0.25, 1.0, 2.0]), (70, [70000.0, 1.0, -3.0, 0.5]), (71, [-70000.0, 2.0, 2.0, 2.0]), (80, [1.0, 65536.0, 0.0, 1e6]), (81, [0.0, 1e6, 1e6, -1e6])]
    expected = brute(rows, 3, 10)
    assert Counter(map(tuple, vafile.top_k(table(spark, rows), 3, every=10).collect())) == expected
    assert any(j == 70 for _, _, j, _ in expected)
    every_row = [(i, [float(x) * 1e5 for x in v]) for i, v in rows[:30]]
    assert Counter(map(tuple, vafile.top_k(table(spark, every_row), 3, every=10).collect())) == brute(every_row, 3, 10)


def test_wide_components_agree_with_sql(spark):
    rows = [(0, [0.5, -1.0]), (1, [70000.0, 0.25]), (2, [1.0, 1.0]), (100, [70000.0, -70000.0])]
    tables = duckdb.connect()
    tables.execute("create table embeddings (vec_id bigint, embedding float[])")
    tables.executemany("insert into embeddings values (?, ?)", rows)
    got = Counter(map(tuple, vafile.top_k(table(spark, rows)).collect()))
    assert got == Counter(tables.sql(ORACLE["op2_exact_top_k"]).fetchall()) and (0, 2, 1, 512 * 71680000 - 1024 * 256) in got


def test_a_score_beyond_64_bits_is_an_error(spark):
    fits = [(0, [1e30, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 3.0])]
    assert Counter(map(tuple, vafile.top_k(table(spark, fits)).collect())) == brute(fits, 10, 100)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        vafile.top_k(table(spark, [(0, [1e30, 0.0]), (1, [1.0, 1.0])])).collect()


def test_the_scan_reads_cells_only(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(300)]
    index = vafile.index(table(spark, rows), "vec_id", "embedding")
    assert index.cells.columns == ["row", "dim", "cells"]
    near = vafile._near(index, np.array([0]), np.zeros((1, 6)), 5)
    plan = index.cells.where("dim = 6").select("row", "cells")._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in plan and near.columns == ["q", "row", "upper", "lower"]


def test_no_rows(spark):
    got = vafile.top_k(table(spark, []))
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
    assert vafile.top_k(table(spark, [(0, [1.0])])).count() == 0


def test_query_equals_sql(spark):
    sf = TESTDATA / "sf0.001"
    tables = duckdb.connect()
    tables.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    got = Counter(map(tuple, op2_exact_top_k(spark, str(sf)).collect()))
    assert got == Counter(tables.sql(ORACLE["op2_exact_top_k"]).fetchall())
