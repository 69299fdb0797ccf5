"""A query for each operator of this package, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    collocations,
    jaccard,
    langid,
    licenses,
    lm_score,
    mixing,
    quality_rank,
    quality_rules,
    search,
    token_counts,
    toxicity,
    vafile,
)
from .common import read
from .sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_classes(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.with_toxicity(docs, labels).withColumnRenamed("id", "doc_id")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.with_scores(read(spark, sf_dir, "documents"), VOCABULARY).withColumnRenamed("id", "doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.with_copies(read(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op7_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_digests(read(spark, sf_dir, "documents"), VOCABULARY).withColumnRenamed("id", "doc_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality_rank.with_quality(docs, labels).withColumnRenamed("id", "doc_id")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.with_language(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), VOCABULARY).withColumnRenamed("id", "doc_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(read(spark, sf_dir, "documents"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.with_licenses(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_exact_top_k,
        op3_toxicity,
        op4_lm_score,
        op5_quality_rules,
        op6_mix_sources,
        op7_bpe_roundtrip,
        op8_quality_classifier,
        op9_language,
        op10_token_counts,
        op11_phrases,
        op12_licenses,
        op13_ranked_search,
    )
}
