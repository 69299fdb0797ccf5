from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import TESTDATA
from tests.llm import cases
from tidemark.llm import jaccard
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLE, op1_jaccard_join
from tidemark.llm.shingles import shingle_sets


def shingles(text):
    w = cases.words(cases.lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    """(set size, smallest id of the component) of each (id, text), comparing all that share a shingle."""
    sets = [shingles(text) for _, text in docs]
    having = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, k in Counter(j for x in s for j in having[x] if j < i).items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        known = least.get(root(i))
        least[root(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return Counter((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(docs))


def found(df):
    return Counter((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard.join_classes(df).collect())


def brute_links(docs):
    """(id, links): of each document the number of others it is linked with."""
    sets = [shingles(text) for _, text in docs]
    links = [sum(i != j and 100 * len(s & t) >= 75 * len(s | t) for j, t in enumerate(sets)) if s else 0 for i, s in enumerate(sets)]
    return Counter((doc_id, n) for (doc_id, _), n in zip(docs, links))


def links_found(df):
    return Counter((r["id"], r["n_links"]) for r in jaccard.join_classes(df).collect())


def variants():
    """Texts of like words: copies, near copies around the threshold, a chain of them, and a shared passage."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, passage = [], rng.choices(vocabulary, k=55)
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(6, 160))
        texts.append(base)
        for changes in (0, 1, 1, 2, 3, 4, 6):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(copy + rng.choices(vocabulary, k=rng.choice([0, 0, 1, 9])))
    chain = rng.choices(vocabulary, k=80)
    for step in range(12):
        chain = chain[:step] + [f"c{step}"] + chain[step + 1 :]
        texts.append(list(chain))
    texts += [rng.choices(vocabulary, k=n) + passage for n in (5, 10, 15, 20, 60, 200)]
    texts += [rng.choices(vocabulary, k=k) for k in (1, 2, 4, 5) for _ in range(2)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_against_brute_force(spark):
    rows = variants()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_links_against_brute_force(spark, monkeypatch):
    """Also those between sets of one component, and with equal sets; in one block and in several."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(120)]
    near = [" ".join(base[:k] + [f"x{i}"] + base[k + 1 :]) for i, k in enumerate(rng.choices(range(120), k=60))]
    rows = [(i, t) for i, (_, t) in enumerate([*variants(), *enumerate(near), *enumerate(near[:7]), (0, ""), (0, None)])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute_links(rows)
    assert links_found(table) == expected and max(n for _, n in expected) > 50
    monkeypatch.setattr(jaccard, "BLOCK", 11)
    assert links_found(table) == expected


def test_links_of_odd_rows(spark):
    got = links_found(cases.odd(spark))
    assert got == brute_links([(r[0], r[1]) for r in cases.odd_rows()])


def test_long_lists_and_frequent_shingles_change_nothing(spark, monkeypatch):
    rows = variants()
    for name, value in (("SHORT", 2), ("BLOCK", 3), ("ONE_OF", 1), ("FREQUENT", 4)):
        monkeypatch.setattr(jaccard, name, value)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows_and_no_rows(spark):
    docs = [(r[0], r[1]) for r in cases.odd_rows()]
    got = found(cases.odd(spark))
    assert Counter((i, n) for i, n, _ in got.elements()) == Counter((i, n) for i, n, _ in brute(docs).elements())
    assert got[(1, len(shingles(cases.SENTENCE * 3)), 1)] == 2
    assert got[(3, 0, 3)] == got[(4, 0, 4)] == got[(5, 0, 5)] == got[(None, 0, None)] == 1
    assert jaccard.join_classes(cases.none(spark)).count() == 0


def test_query_equals_sql(spark):
    sf = TESTDATA / "sf0.001"
    tables = duckdb.connect()
    tables.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    expected = Counter(tables.sql(ORACLE["op1_jaccard_join"]).fetchall())
    assert Counter(map(tuple, op1_jaccard_join(spark, str(sf)).collect())) == expected


def test_one_of_each_group_stays(spark):
    docs = cases.odd(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 3, 4, 5, 6, None, 8, 9, 10])  # the null id's set is that of id 1; the null text stays
    small = cases.small(spark)
    lead = {c for (_, _, c) in brute([(r["doc_id"], r["text"]) for r in small.collect()])}
    assert {r["doc_id"] for r in jaccard.keep_one(small).collect()} == lead
    assert jaccard.keep_one(cases.none(spark)).count() == 0


def test_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(0)
    for size in (1, 40, 3000, 9000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 1 << 63, size * 2).astype(np.uint64)]))
        bits = jaccard.differing([jaccard.bitmap(a)], [jaccard.bitmap(b)])[0]
        assert bits <= len(np.setxor1d(a, b))
        assert jaccard.differing([jaccard.bitmap(a)], [jaccard.bitmap(a)])[0] == 0


def test_shingles_of_a_block_stay_in_their_text():
    texts = ["a b c d e f", "", None, "a b c d e f g", "f", "A B C D E"]
    sets = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [2, 0, 0, 3, 1, 1]
    assert set(sets[0]) < set(sets[3]) and set(sets[5]) < set(sets[0])


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 9)] + [(20, 21), (21, 5), (40, 41)]])
def test_components(spark, links):
    parent = {n: n for pair in links for n in pair}
    for _ in links:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == set(parent.items())
