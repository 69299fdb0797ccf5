"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

N-grams of four to seven characters, those over word boundaries included, tell stems
at the beginning of words from the same letters elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import is_fold, lean
from .labelled import sample
from .ngrams import grams

LENGTHS = (4, 5, 6, 7)
BITS = 20


def _distinct(codes: Sequence[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(codes))


def evidence(ones: np.ndarray, zeros: np.ndarray, all_ones: float, all_zeros: float) -> np.ndarray:
    """For buckets in ``ones`` texts of label 1 and ``zeros`` of label 0 the log-likelihood ratio statistic G.

    That is twice the gain in log likelihood from letting the bucket depend on the
    label, over the table of texts with and without it.
    """
    seen, whole = ones + zeros, all_ones + all_zeros
    total = np.zeros(len(seen))
    for found, of in ((ones, all_ones), (zeros, all_zeros)):
        for cell, expected in ((found, seen * of / whole), (of - found, (whole - seen) * of / whole)):
            some = cell > 0
            total[some] += cell[some] * np.log(cell[some] / expected[some])
    return 2 * total


def fit(
    texts: Sequence[str], labels: Sequence[int], rounds: int = 120, decay: float = 1e-3, least: int = 3, least_evidence: float = 13.0
) -> tuple[np.ndarray, float]:
    """The weight of each bucket, and the bias.

    A text's features are the buckets it has, whatever their number, each scaled by
    the log of the ratio of its smoothed shares in texts of label 1 and label 0.
    Buckets of fewer than ``least`` texts, or whose :func:`evidence` is below
    ``least_evidence`` (by chance one in some 3,000 is above), are left out: in long texts
    they would drown the others. Logistic loss, half of its weight on either label,
    with weight ``decay`` on the squared weights, by Adam on the whole sample. With one
    class only, all weights are 0.
    """
    y = np.asarray(labels, np.float64)
    weights = np.zeros(1 << BITS)
    ones, zeros = float(y.sum()), float(len(y) - y.sum())
    if not ones or not zeros:
        return weights, float(np.log((ones + 0.5) / (zeros + 0.5)))
    texts = pa.array(texts, pa.large_string())
    found = np.zeros((2, 1 << BITS))  # texts of label 0 and 1 that have a bucket
    for i, codes in grams(texts, LENGTHS, BITS):
        found[int(y[i]), _distinct(codes)] += 1
    q, p = found + 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    keep = (found.sum(axis=0) >= least) & (evidence(found[1], found[0], ones, zeros) >= least_evidence)
    rows = [own[keep[own]] for own in (_distinct(codes) for _, codes in grams(texts, LENGTHS, BITS))]  # the few that are kept
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, cols = np.unique(np.concatenate(rows), return_inverse=True)
    scale = ratio[used].astype(np.float32)
    value = scale[cols]
    share = np.where(y == 1, 0.5 / ones, 0.5 / zeros)
    w, b = np.zeros(len(used)), 0.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(owner, weights=value * w[cols], minlength=len(y)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * share
        slope = np.bincount(cols, weights=value * error[owner], minlength=len(used)) + decay * w
        slope = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        step = 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    weights[used] = w * scale
    return weights, b


def scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 for each whole text; one without n-grams has that of the bias alone."""
    out = np.full(len(texts), bias)
    last = np.zeros(len(weights), np.int64)
    for i, codes in grams(texts, LENGTHS, BITS):
        all_codes = np.concatenate(codes)
        place = np.arange(len(all_codes))
        last[all_codes] = place  # of equal buckets one place stays, so each counts once
        out[i] += weights[all_codes[last[all_codes] == place]].sum()
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def score(text: Column, weights: np.ndarray, bias: float) -> Column:
    """The model's score (double, 0 to 1) of each whole text; null counts as empty.

    The weights that are not 0, of at most 2 ** 20, go along with the function.
    """
    used = np.flatnonzero(weights)
    sent = used.astype(np.int32), weights[used].astype(np.float32)

    @F.arrow_udf("double")
    @lean
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        small = np.zeros(1 << BITS, np.float32)
        small[sent[0]] = sent[1]
        for batch in batches:
            yield pa.array(scores(batch, small, bias), pa.float64())

    return toxicity(text)


def with_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    least: float = 0.7,
    per_class: int = 2000,
    most_bytes: int = 16384,
) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``, fitted on ``labels``.

    Learns from a bounded sample (:func:`labelled.sample`) outside the fold held out.
    Null and empty texts get the score of the bias, equal texts equal scores; rows
    without an id count as held out; an empty table gives an empty result; other
    columns are not looked at.
    """
    rows = sample(docs, labels, label_col, per_class, most_bytes, id_col=id_col, text_col=text_col)
    weights, bias = fit([t for t, _ in rows], [y for _, y in rows])
    got = docs.select(
        F.col(id_col).alias("id"),
        is_fold(F.col(id_col), 3, 1).alias("held_out"),
        score(F.col(text_col), weights, bias).alias("score"),
    )
    return got.withColumn("predicted", (F.col("score") >= least).cast("int"))
