"""From raw documents to token ids: filter, deduplicate, mix, encode.

``STAGES`` holds (name, function) pairs. A function takes (spark, docs, sf_dir) and
returns a DataFrame; what it returns is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, jaccard, mixing, quality_rank, quality_rules
from tidemark.llm.common import read, ready, written
from tidemark.llm.queries import VOCABULARY

#: Arrow batches of the stages: workers of several stages share an executor's memory.
LIGHT = {"rows": "500", "size": "2m"}

#: No SQL expresses the fitted stages; the tests hold each stage against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier scores 0.5 or more; learnt from the labels of the two open folds."""
    ready(spark, **LIGHT)
    return quality_rank.keep_good(docs, read(spark, sf_dir, "labels"))


def weak_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and whose votes make good quality likelier than not."""
    ready(spark, **LIGHT)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 5-word shingles at 0.75 hold together."""
    ready(spark, **LIGHT)
    return jaccard.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    ready(spark, **LIGHT)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each row."""
    ready(spark, **LIGHT)
    return bpe.with_digests(docs, VOCABULARY, keep_ids=True, remembered=40_000).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", weak_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each on what the one before has written."""
    ready(spark, **LIGHT)
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
