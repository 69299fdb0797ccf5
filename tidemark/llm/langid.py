"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import is_fold, join_few, share, written
from .ngrams import grams

LENGTHS = (1, 2, 3)
BITS = 14
SIZE = 16
UNKNOWN = "und"


@dataclass
class Model:
    """Languages, logits by bucket (the embeddings times the softmax layer), bias, temperature, least score."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


def _mean(codes: Sequence[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(codes)
    return np.bincount(flat, minlength=1 << BITS).astype(np.float32) / max(1, len(flat))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(
    texts: Sequence[str], languages: Sequence[str], epochs: int = 25, rate: float = 0.5, seed: int = 9, aim: float = 0.98
) -> Model:
    """Stochastic gradient descent on four of five texts, calibration on the fifth.

    Besides each whole text a run of 3 to 15 of its words is learnt, so that short
    texts are known too. The temperature makes the scores of the texts set aside
    likeliest; ``least`` is the lowest score from which on at least ``aim`` of them
    are right. Without texts the model has no language.
    """
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    random = np.random.default_rng(seed)
    index = {name: k for k, name in enumerate(names)}
    rows, y, apart, learnt = [], [], [], set()
    for i, (text, language) in enumerate(zip(texts, languages)):
        words = text.split()
        n = min(len(words), int(random.integers(3, 16)))
        at = int(random.integers(0, len(words) - n + 1))
        rows += [text, " ".join(words[at : at + n])]
        y += [index[language]] * 2
        apart += [i % 5 == 4 and language in learnt] * 2  # a language's first text is always learnt
        learnt.add(language)
    x = np.stack([_mean(codes) for _, codes in grams(pa.array(rows, pa.large_string()), LENGTHS, BITS)])
    y, apart = np.array(y), np.array(apart)
    if apart.all() or not apart.any():
        apart = np.zeros(len(y), bool)
    embed = (random.standard_normal((1 << BITS, SIZE)) * 0.1).astype(np.float32)
    layer, bias = np.zeros((SIZE, len(names)), np.float32), np.zeros(len(names), np.float32)
    layer += random.standard_normal(layer.shape).astype(np.float32) * 0.1
    used_rows = np.flatnonzero(~apart)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for batch in np.array_split(random.permutation(used_rows), max(1, len(used_rows) // 32)):
            xb = x[batch]
            hidden = xb @ embed
            error = _softmax(hidden @ layer + bias)
            error[np.arange(len(batch)), y[batch]] -= 1
            error /= len(batch)
            back = error @ layer.T
            layer -= step * (hidden.T @ error)
            bias -= step * error.sum(axis=0)
            used = np.flatnonzero(xb.any(axis=0))
            embed[used] -= step * 20 * (xb[:, used].T @ back)
    logits = embed @ layer
    check = apart if apart.any() else ~apart
    z, truth = x[check] @ logits + bias, y[check]
    sure = np.arange(len(truth))
    losses = {t: -np.log(_softmax(z / t)[sure, truth] + 1e-12).mean() for t in np.geomspace(0.25, 10, 40)}
    temperature = float(min(losses, key=losses.get))
    p = _softmax(z / temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best)
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= aim)
    least = float(best[order][good[-1]]) if len(good) else 1.0
    return Model(names, logits.astype(np.float32), bias, temperature, least)


def predict(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language and its calibrated probability, for each whole text."""
    z = np.zeros((len(texts), len(model.languages)), np.float64)
    for i, codes in grams(texts, LENGTHS, BITS):
        flat = np.concatenate(codes)
        if len(flat) < 1 << (BITS - 2):
            z[i] = model.logits[flat].sum(axis=0, dtype=np.float64) / max(1, len(flat))
        else:
            z[i] = np.bincount(flat, minlength=1 << BITS) @ model.logits.astype(np.float64) / len(flat)
    p = _softmax((z + model.bias) / model.temperature)
    return p.argmax(axis=1), p.max(axis=1)


def language(text: Column, model: Model) -> Column:
    """A struct (lang_pred, score, rejected) for each whole text.

    A null text and one without a letter are ``und`` with score 0 and rejected. Other
    texts get the likeliest language; ``rejected`` says that its score is below the
    calibrated least.
    """
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if not model.languages:
        return none

    @F.arrow_udf("lang_pred string, score double, rejected boolean")
    def likeliest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            best, p = predict(batch, model)
            yield pa.StructArray.from_arrays(
                [pa.array([model.languages[k] for k in best], pa.string()), pa.array(p, pa.float64()), pa.array(p < model.least)],
                ["lang_pred", "score", "rejected"],
            )

    return F.when(text.rlike(r"\p{L}"), likeliest(text)).otherwise(none)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, most_bytes: int) -> list[tuple[str, str]]:
    """(text, language) of up to ``per_language`` texts of each language outside the fold held out.

    The first by md5 of the id; whole texts, none above ``most_bytes``. A language that
    has only longer ones gives its shortest, of ``per_language * most_bytes`` bytes
    together, but at least one. In all 50 times ``per_language`` at most, or one of each
    language if these are more.
    """
    size = F.octet_length("_text")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).where(
        F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~is_fold(F.col("_id"), 3, 1)
    )
    first = F.md5(F.col("_id").cast("string")), F.col("_id"), F.col("_text")
    seen = written(rows.groupBy("_lang").agg(F.count_if(size <= most_bytes).alias("_n")), "languages")
    short = join_few(rows.where(size <= most_bytes), seen, ["_lang"]).where(share(F.col("_id")) < 3 * per_language / F.col("_n"))
    ranked = short.withColumn("_rank", F.row_number().over(Window.partitionBy("_lang").orderBy(*first)))
    ranked = ranked.where(F.col("_rank") <= per_language).select("_lang", "_text", "_rank")
    only_long = seen.where("_n = 0").select("_lang")
    if not only_long.isEmpty():
        by_size = Window.partitionBy("_lang").orderBy(size, *first)
        shortest = join_few(rows, only_long, ["_lang"]).withColumn("_rank", F.row_number().over(by_size)).where(F.col("_rank") <= per_language)
        together = F.sum(size).over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        shortest = shortest.withColumn("_sum", together).where((F.col("_rank") == 1) | (F.col("_sum") <= per_language * most_bytes))
        ranked = ranked.unionByName(shortest.select("_lang", "_text", "_rank"))
    few = ranked.orderBy("_rank", "_lang").limit(max(50 * per_language, seen.count()))
    return [(r["_text"], r["_lang"]) for r in few.select("_text", "_lang").collect()]


def with_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    most_bytes: int = 8192,
) -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) for each row of ``docs``.

    Learns from a bounded sample (:func:`sample`). Equal texts get equal results; rows
    without an id count as held out; without any language to learn from all is
    ``und``; an empty table gives an empty result; other columns are not looked at.
    """
    rows = sample(docs, id_col, text_col, lang_col, per_language, most_bytes)
    model = fit([t for t, _ in rows], [name for _, name in rows])
    got = docs.select(
        F.col(id_col).alias("id"),
        is_fold(F.col(id_col), 3, 1).alias("held_out"),
        language(F.col(text_col), model).alias("l"),
    )
    return got.select("id", "held_out", "l.lang_pred", "l.score", "l.rejected")
