"""Phrase mining, license scans and ranked search against brute force and SQL."""

from __future__ import annotations

import math
import os
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA, rows
from tests.llm import cases
from tidemark.llm import collocations, licenses, queries, search
from tidemark.llm.licenses import PHRASES, TEMPLATES, stride_of

SF_DIR = TESTDATA / "sf0.001"


@pytest.mark.parametrize("name", ["op11_phrases", "op12_licenses", "op13_ranked_search"])
def test_queries_equal_sql(spark, name):
    tables = duckdb.connect()
    for table in ("documents", "benchmark"):
        tables.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    got = queries.QUERIES[name](spark, str(SF_DIR)).toArrow()
    expected = tables.sql(queries.ORACLE[name]).to_arrow_table()
    columns = sorted(expected.column_names)
    assert sorted(got.column_names) == columns and expected.num_rows

    def multiset(table):
        return Counter(zip(*(table[c].to_pylist() for c in columns)))

    assert multiset(got) == multiset(expected)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lower(text))


# Phrases


def brute_phrases(docs, most, least):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", cases.lower(text)):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in found.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    inside[part] = max(inside[part], a)
        scored = []
        for p, a in found.items():
            if 100 * inside[p] < 50 * a:
                cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return Counter(out)


def phrase_texts():
    rng = random.Random(3)
    common = ["new york city", "New York", "the end of", "of the", "in the end", "ÄRGER über alles", "a b a b a b", "x-1 \x00 y"]
    texts = [
        rng.choice([" ", ". ", ", ", "\n", "\t "]).join(rng.choice(common + ["end", "of", f"w{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 60)))
        for _ in range(150)
    ]
    return [(rng.choice(["en", "de", None, "und", "en", "en"]), t) for t in texts] + [("en", None), ("en", ""), ("fr", " .. "), (None, None), ("en", "the end of " * 4000)]


@pytest.mark.parametrize("ids", [collocations.IDS, 8, 0])
def test_phrases_do_not_depend_on_the_number_of_ids(spark, monkeypatch, ids):
    texts = phrase_texts()
    docs = spark.createDataFrame([(t, x, 1, 2, 3) for x, t in texts], "text string, lang string, a int, c int, word int").repartition(5)
    got = collocations.phrases(docs, most=15, least=4, ids=ids)
    assert Counter(map(tuple, got.collect())) == brute_phrases(texts, 15, 4)


def test_tiles_and_rows_count_exactly(monkeypatch):
    monkeypatch.setattr(collocations, "AT_ONCE", 5000)
    monkeypatch.setattr(collocations, "DENSE", 700)
    rng = np.random.default_rng(5)
    tiles, hashes = collocations.Tiles(), collocations.Rows(2)
    expected = Counter()
    for _ in range(9):
        a, b = (np.where(rng.random(3000) < 0.6, rng.integers(0, 40, 3000), rng.integers(0, 1 << 20, 3000)) for _ in range(2))
        expected.update(zip(a.tolist(), b.tolist()))
        tiles.add(a, b)
        hashes.add(a.astype(np.uint64), b.astype(np.uint64))
    codes, counts = tiles.take()
    a, b = collocations.ids_of(codes)
    assert (np.diff(codes) > 0).all()
    assert dict(zip(zip(a.tolist(), b.tolist()), counts.tolist())) == expected
    (a, b), counts = hashes.take()
    assert dict(zip(zip(a.tolist(), b.tolist()), counts.tolist())) == expected
    assert len(tiles.take()[1]) == len(hashes.take()[1]) == 0


def test_tasks_hand_on_what_they_cannot_hold(spark, monkeypatch):
    docs = [("en", " ".join(f"w{i % 37}" for i in range(k, k + 500))) for k in range(40)]
    monkeypatch.setattr(collocations, "AT_ONCE", 100)
    monkeypatch.setattr(collocations, "HELD", 16)
    table = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    for ids in (1 << 20, 5):
        assert Counter(map(tuple, collocations.phrases(table, 100, 10, ids).collect())) == brute_phrases(docs, 100, 10)


def test_phrases_of_large_counts_are_exact(spark):
    table = spark.createDataFrame([(3_000_000_019, 3_000_000_021, 4_000_000_003)], "a long, l long, r long")
    assert table.select(collocations._score("a", "l", "r")).first()[0] == 10**6 * 3_000_000_019**2 // (3_000_000_021 * 4_000_000_003)


def test_phrases_of_odd_rows(spark):
    got = collocations.phrases(cases.odd(spark), least=3)
    assert Counter(map(tuple, got.collect())) == brute_phrases([(r[2], r[1]) for r in cases.odd_rows()], 2000, 3)
    assert collocations.phrases(cases.none(spark)).count() == 0


# Licenses


def brute_licenses(text):
    w = terms(text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    shares = []
    for label, template in TEMPLATES:
        words, stride = set(terms(template)), stride_of(len(terms(template)))
        for k in range(0, len(w), stride):
            overlap = len(words & set(w[k : k + 2 * stride]))
            if 5 * overlap >= 4 * len(words):
                shares.append((overlap / len(words), label))
    base = sorted({label for _, label in places})
    labels = sorted({label for _, label in places + shares})
    score = 1.0 if places else max((s for s, _ in shares), default=0.0)
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(labels), score


def license_texts():
    rng = random.Random(8)
    notices = [t for _, t in TEMPLATES] + list(PHRASES)
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            notice = rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):  # words left out, put in, doubled
                k = rng.randrange(len(notice))
                notice[k : k + 1] = rng.choice([[], ["word"], [notice[k], notice[k]], [notice[k].upper()]])
                notice = notice or ["none"]
            parts += ["text"] * rng.randint(0, 40) + notice
        texts.append(" ".join(parts))
    return [*texts, None, "", "CC  by\n", "cc", "All-Rights/Reserved all rights reserved", "the license " * 3000 + "Released under the MIT License"]


def test_licenses_against_brute_force(spark):
    texts = license_texts()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, word int, blocks string")
    got = {r[0]: tuple(r)[1:] for r in licenses.with_licenses(docs.repartition(3)).collect()}
    assert got == {i: brute_licenses(t) for i, t in enumerate(texts)}
    assert sum(bool(x[5]) for x in got.values()) > 60 and any(x[5] and not x[4] for x in got.values())


def test_blocks_are_spans_of_words(spark):
    text = "one two " * 9 + "This work is licensed under the GNU General Public License, version 3."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.scan(docs).first()
    assert [(p.label, p.first) for p in found.places] == [("gpl", 25)]
    words = terms(text)
    gpl = next(b for b in found.blocks if b.label == "gpl-3.0")
    assert gpl.size == 12 and gpl.overlap == len(set(words[gpl.first : gpl.last + 1]) & set(terms(TEMPLATES[8][1]))) >= 10


def test_own_templates(spark):
    docs = spark.createDataFrame([(1, "b c d e f"), (2, "b c x"), (3, "p q")], "doc_id long, text string")
    got = licenses.with_licenses(docs, templates=[("t", "a b c d e"), ("u", "b c")], phrases={"p q": "pq"})
    assert [(r.id, r.labels, r.score) for r in got.orderBy("id").collect()] == [(1, "t,u", 1.0), (2, "u", 1.0), (3, "pq", 1.0)]


def test_licenses_of_odd_rows(spark):
    got = Counter(tuple(r)[1:] for r in licenses.with_licenses(cases.odd(spark)).collect())
    assert got == Counter(brute_licenses(r[1]) for r in cases.odd_rows())
    assert licenses.with_licenses(cases.none(spark)).count() == 0


# Ranked search


def brute_search(docs, items, k):
    docs = [(i, Counter(terms(t))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    whole, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * whole // length
            score = sum(
                math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def search_tables():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 80)))) for i in range(300)]
    docs += [(400, "w1 w1, W59"), (401, "w1 w1 w59"), (401, "w1 w1 w59"), (None, "w1 w1 w59"), (500, None), (501, "... ,"), (502, "w0 " * 20000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(25)]
    return docs, items + [(3, "w59 w59 w1"), (None, "w7 w8"), (90, None), (91, "unknown"), (92, "W0")]


@pytest.mark.parametrize("small", [False, True])
def test_search_against_brute_force(spark, monkeypatch, small):
    if small:  # many blocks of documents and of items
        monkeypatch.setattr(search, "POSTINGS", 100)
        monkeypatch.setattr(search, "ITEM_BYTES", 200)
    docs, items = search_tables()
    table = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, n int, id int").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = search.search(table, asked, k=5)
    assert Counter(map(tuple, got.collect())) == brute_search(docs, items, 5)


def test_no_new_accumulators_once_the_rest_cannot_reach(monkeypatch):
    """One rare and one frequent term: documents that hold only the frequent one get no accumulator."""
    n = 1000
    ids, sizes = np.arange(n), np.where(np.arange(n) < 20, 2, 1)
    terms_of_docs = np.concatenate([[0, 1] if i < 20 else [1] for i in range(n)])
    part = search.Inverted(ids, np.full(n, 50), sizes, terms_of_docs, np.ones(len(terms_of_docs), np.int64), n, 50 * n)
    weights = np.array([search.weight(20, n), search.weight(n, n)])
    found, scores = part.best(np.array([0, 1]), weights, 5, 0)
    assert (part.sums > 0).sum() == 20 and set(found) == set(range(20)) and len(set(scores)) == 1


def test_search_of_odd_rows(spark):
    odd = cases.odd(spark)
    items = odd.withColumnRenamed("doc_id", "item_id")
    rows_in = [(r[0], r[1]) for r in cases.odd_rows()]
    assert Counter(map(tuple, search.search(odd, items).collect())) == brute_search(rows_in, rows_in, 20)
    for docs, asked in ((cases.none(spark), items), (odd, cases.none(spark).withColumnRenamed("doc_id", "item_id"))):
        assert rows(search.search(docs, asked)) == []


def test_operators_delete_what_they_wrote_on_the_way(spark):
    """Only the result stays in the shared folder, also after a failure."""
    shared = spark.conf.get("spark.checkpoint.dir")
    docs = spark.createDataFrame([(1, "one two three", "en"), (2, "two three four", "en")], "doc_id long, text string, lang string")
    before = set(os.listdir(shared))
    found = search.search(docs, docs.withColumnRenamed("doc_id", "item_id"))
    mined = collocations.phrases(docs, least=2)
    assert {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before} == {"search", "phrases"}
    assert found.count() == 4 and [r.phrase for r in mined.collect()] == ["two three"]
    before = set(os.listdir(shared))
    broken = docs.withColumn("text", F.when(F.col("doc_id") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        collocations.phrases(broken)
    assert set(os.listdir(shared)) == before


def test_counting_phrases_needs_little_more_than_what_it_counts():
    """Blocks are small beside a batch, and what a merge has taken over is free before the merge sorts it."""
    texts = pa.array([" ".join(f"w{i * 7 % 5000}" for i in range(k, k + 900)) for k in range(800)])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], ["lang", "text"])

    def peak(work) -> int:
        tracemalloc.start()
        try:
            work()
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(lambda: [None for _ in collocations._words(batch)]) < 25 * texts.nbytes
    rows, n = collocations.Rows(3), 1 << 20
    keys = np.random.default_rng(3).integers(0, 1 << 40, (3, n), np.uint64)

    def merged() -> None:
        for at in range(0, n, 1 << 16):
            rows.add(*(k[at : at + (1 << 16)].copy() for k in keys))
        rows._merge()

    assert peak(merged) < 14 * 8 * n
    assert rows.take()[1].sum() == n
