"""Several runs over random batches, against the same steps in plain Python."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import RunConfig, run_incremental
from tidemark.functions import keyed_uuid
from tidemark.operators import ask_table
from tidemark.sources import CacheTable, StateTable, new_folder

SECRET = b"s" * 70  # longer than a hash block
DAY = dt.date(2024, 5, 10)
SCHEMA = "id string, code string, group_id int, created_at int, description string"


def uuid_of(text):
    digest = hmac.new(SECRET, text.encode(), hashlib.sha256).digest()
    return str(uuid.UUID(bytes=digest[:16], version=4))


def sha(row):
    return hashlib.sha256("||".join(str(v) for v in (row[1], row[0], row[2]) if v is not None).encode()).hexdigest()


def rank(row):
    return [(v is not None, v) for v in (row[3], row[2], row[4])]


class Model:
    def __init__(self):
        self.state, self.cache = {}, set()

    def run(self, batch, known):
        latest = {}
        for row in batch:
            key = row[:2]
            if key not in latest or rank(row) > rank(latest[key]):
                latest[key] = row
        valid = [r for r in latest.values() if r[4] is not None and r[1] is not None]
        new = [r for r in valid if None in r[:2] or self.state.get(r[:2]) != sha(r)]
        self.cache |= {r[0] for r in new} & known
        out = [(*r, sha(r), uuid_of(f"{uuid_of(r[0])}||{r[1]}")) for r in new if r[0] in self.cache]
        self.state.update({r[:2]: r[5] for r in out})
        counters = {
            "raw_count": len(valid),
            "new_count": len(new),
            "repeated_count": len(valid) - len(new),
            "matched_count": len(out),
            "not_matched_count": len(new) - len(out),
            "transformed_count": len(out),
            "valid_rows": len(out),
            "status": "success",
        }
        return out, counters


@pytest.mark.parametrize("seed, hot_rows", [(1, 1_000_000), (2, 5)])
def test_runs(spark, seed, hot_rows):
    rng = random.Random(seed)
    ids = [str(i) for i in range(40)] + ["hot"] * 20 + [None] * 5
    root = new_folder(spark, "model")
    conf = RunConfig(root, SECRET, page_size=7, hot_rows=hot_rows, sample_size=0)
    model = Model()
    for number in range(4):
        batch = [
            (rng.choice(ids), rng.choice(["a", "b", "c", None]), rng.choice([1, 2]), rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]))
            for _ in range(150)
        ]
        known = {i for i in set(ids) - {None} if rng.random() < 0.5}
        path = new_folder(spark, "day")
        spark.createDataFrame(batch, SCHEMA).write.parquet(f"{path}/year=2024/month=5/day=10")
        service = spark.createDataFrame([(i,) for i in known], "id string").withColumn("uuid", keyed_uuid("id", SECRET))
        result = run_incremental(spark, conf, spark.read.parquet(path), ask_table(service), DAY, f"run{number}")

        expected, counters = model.run(batch, known)
        columns = ["id", "code", "group_id", "created_at", "description", "sha2", "uuid"]
        assert rows(result.output.select(columns)) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
        assert result.report.sections["process"] == counters
        state = {(r.id, r.code): r.sha2 for r in StateTable(spark, f"{root}/state").read().collect()}
        assert state == model.state
        cached = CacheTable(spark, f"{root}/cache").read().agg(F.count("*"), F.count_distinct("id")).first()
        assert tuple(cached) == (len(model.cache), len(model.cache))
