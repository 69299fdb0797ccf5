from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tests.conftest import TESTDATA
from tests.llm import cases
from tests.llm.test_jaccard import brute
from tests.llm.test_texts import counted
from tidemark.llm.common import written
from tidemark.llm.queries import QUERIES

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage makes of what the one before has left."""
    docs = cases.small(spark)
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(written(stage(spark, made[-1], SF_DIR), "test"))
    return made


def test_registered():
    assert {"pipeline", *QUERIES} <= driver.queries().keys()
    assert len(QUERIES) == 13 and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_clean_documents(spark, stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    quality = {r["doc_id"]: r["quality"] for r in cases.small_labels(spark).collect()}
    docs = [{r["doc_id"]: r["text"] for r in df.collect()} for df in stages[:5]]
    good = {i for i, q in quality.items() if q}
    assert len(good & docs[0].keys() - docs[1].keys()) <= 0.05 * len(good)  # the classifier: clean ones stay
    assert not {i for i, q in quality.items() if not q} & docs[2].keys()  # after both filters no junk is left
    assert {i for i in good & docs[1].keys() if not counted(docs[1][i])[-1]} <= docs[2].keys()
    lead = {c for _, _, c in brute(list(docs[2].items()))}
    assert docs[3].keys() == lead


def test_mix_and_ids(stages):
    kept, mixed, coded = (df.collect() for df in stages[3:6])
    times = Counter(r["doc_id"] for r in mixed)
    assert times.keys() <= {r["doc_id"] for r in kept} and max(times.values()) <= 2
    sizes, taken = Counter(), Counter()
    for r in kept:
        sizes[r["source"]] += len(cases.words(r["text"]))
    for r in mixed:
        taken[r["source"]] += len(cases.words(r["text"]))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 0.1 * sum(sizes.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids), sha(r["text"])) for r in mixed)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in coded) == expected


def test_run_is_the_stages(spark, stages):
    assert Counter(r["ids_sha256"] for r in corpus_pipeline.run(spark, SF_DIR).collect()) == Counter(r["ids_sha256"] for r in stages[5].collect())


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows_and_none(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    got = stage(spark, cases.odd(spark), SF_DIR)
    assert number == 4 or got.columns == cases.odd(spark).columns
    got.collect()
    assert stage(spark, cases.none(spark), SF_DIR).count() == 0
