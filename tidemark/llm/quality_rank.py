"""Quality classifier: Bradley-Terry scores learnt from preference pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, free_name, is_fold, lean, written
from .word_hashes import hashes, spans

#: Bytes whose share of a text is a feature each.
SIGNS = b"#*$%&|<>!?.,;:-_/\\@()[]{}\"'=+~^`"
N_FEATURES = len(SIGNS) + 13
#: Rows of the commoner label in a task that pairs them, of the rarer one at least, and the partners each one meets.
PER_TASK, FEWEST, TIMES = 32_768, 256, 2
#: Sums that one task, or the driver, adds up at once.
FAN_IN = 64


def features(texts: pa.Array) -> np.ndarray:
    """A row of shares and lengths for each whole text: signs, letters by case, digits, lines, words, repeats."""
    out = np.zeros((len(texts), N_FEATURES))
    for first, last, data, offsets in blocks(texts):
        n = last - first
        owner = np.repeat(np.arange(n), np.diff(offsets))
        seen = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256)
        size = np.maximum(1, np.diff(offsets))[:, None]
        starts, ends, number = spans(data, offsets)
        codes = hashes(data, starts, ends)
        words = np.diff(number)
        some = np.maximum(1, words)
        of = np.repeat(np.arange(n), words)
        same = np.zeros((2, len(codes)))
        for k in (1, 2):
            same[k - 1, k:] = (codes[k:] == codes[:-k]) & (of[k:] == of[:-k])
        order = np.lexsort((codes, of))
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (of[order][1:] != of[order][:-1])
        count = lambda x: np.bincount(of, weights=x, minlength=n)
        last_byte = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        odd_end = np.isin(last_byte, np.frombuffer(b"#*$%&|<>!", np.uint8))
        length = (ends - starts).astype(float)
        cols = [
            seen[:, list(SIGNS)] / size,
            seen[:, 0x41:0x5B].sum(1, keepdims=True) / size,
            seen[:, 0x61:0x7B].sum(1, keepdims=True) / size,
            seen[:, 0x30:0x3A].sum(1, keepdims=True) / size,
            seen[:, 0x80:].sum(1, keepdims=True) / size,
            seen[:, [0x0A]] / size,
            seen[:, [0x20]] / size,
            np.log1p(words)[:, None] / 10,
            (count(length) / some)[:, None] / 10,
            (count(same[0]) / some)[:, None],
            (count(same[1]) / some)[:, None],
            (count(odd_end) / some)[:, None],
            np.sqrt(np.bincount(of[order], weights=fresh, minlength=n) / some)[:, None],
            (words < 50)[:, None],
        ]
        out[first:last] = np.concatenate(cols, axis=1)
    return out


@dataclass
class Model:
    """Means and deviations of the features, their weights, and the score from which a text is good."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    threshold: float


def fit(x: np.ndarray, labels: Sequence[int], bad_share: float, pairs: int = 60_000, rounds: int = 300, decay: float = 1e-3, seed: int = 8) -> Model:
    """Weights so that of a pair the text of label 1 has the higher score, by logistic loss on differences.

    ``pairs`` random pairs of a good and a bad text. The threshold is the quantile of
    the scores at ``bad_share``, each label weighted so that the sample has that share
    of label 0, moved into the widest gap between scores from 0.8 to 1.1 times it. With one class only every score is 0 and the threshold says that class.
    """
    y = np.asarray(labels)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        mean = np.zeros(N_FEATURES)
        return Model(mean, np.ones(N_FEATURES), np.zeros(N_FEATURES), -1.0 if len(good) or not len(bad) else 1.0)
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / deviation, -8, 8)
    random = np.random.default_rng(seed)
    difference = z[random.choice(good, pairs)] - z[random.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        wrong = 1 / (1 + np.exp(np.clip(difference @ w, -40, 40)))
        slope = -(difference * wrong[:, None]).mean(axis=0) + decay * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    scores = z @ w
    weight = np.where(y == 1, (1 - bad_share) / len(good), bad_share / len(bad))
    order = np.argsort(scores)
    upto = np.cumsum(weight[order])
    near = np.flatnonzero((upto >= 0.8 * bad_share) & (upto <= 1.1 * bad_share))
    near = near[near < len(order) - 1]
    if not len(near):
        near = np.array([min(len(order) - 2, int(np.searchsorted(upto, bad_share)))])
    k = near[np.argmax(scores[order][near + 1] - scores[order][near])]
    low, high = scores[order][k], scores[order][k + 1]
    return Model(mean, deviation, w, float((low + high) / 2))


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Of each whole text 1 / (1 + exp(threshold - score)): at least 0.5 from the threshold on."""
    z = np.clip((features(texts) - model.mean) / model.deviation, -8, 8)
    z = (z * model.weights).sum(axis=1) - model.threshold  # a row's sum does not depend on the other rows
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(text: Column, model: Model) -> Column:
    """The model's score (double, 0 to 1) of each whole text; null counts as empty."""

    @F.arrow_udf("double")
    @lean
    def quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(scores(batch, model), pa.float64())

    return quality(text)


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(h, label, x), written: the id's hash, label and features of every labelled text outside the fold held out.

    Features are made before the join, so that no text is shuffled.
    """

    @F.arrow_udf("array<double>")
    @lean
    def shares(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * N_FEATURES)
            yield pa.ListArray.from_arrays(ends, pa.array(features(batch).ravel()))

    taught = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(~is_fold(F.col("_id"), 3, 1) & F.col("_text").isNotNull())
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    rows = taught.select("_id", shares("_text").alias("x")).join(known, "_id")
    return written(rows.select(F.xxhash64(F.col("_id").cast("string")).alias("h"), "label", "x"), "quality-features")


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _pairs(table: DataFrame, mean: np.ndarray, deviation: np.ndarray, good: int, bad: int) -> tuple[DataFrame, int]:
    """(d), written: differences of a good and a bad row's features, many in a row; and the tasks that made them.

    Rows are dealt over the tasks by their ids, those of the rarer label to several
    tasks where a task would have less than ``FEWEST``. In its task each row meets
    ``TIMES`` partners at least, in an order that depends on the rows alone.
    """
    parts = -(-max(good, bad) // PER_TASK)
    copies = min(parts, -(-parts * FEWEST // min(good, bad)))
    more = F.when(F.col("label") == int(good < bad), copies - 1).otherwise(0)
    part = F.pmod(F.pmod("h", F.lit(parts)) + F.col("copy"), F.lit(parts))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(batch.column(0).to_numpy(), _matrix(batch.column(1))) for batch in batches if batch.num_rows]
        if not rows:
            return
        y, x = (np.concatenate(c) for c in zip(*rows))
        z = np.clip((x - mean) / deviation, -8, 8)
        z, y = z[(order := np.lexsort([*x.T, y]))], y[order]
        sides, random = (z[y == 1], z[y == 0]), np.random.default_rng(8)
        most = max(map(len, sides)) if min(map(len, sides)) else 0
        for _ in range(TIMES):
            a, b = (side[np.resize(random.permutation(len(side)), most)] for side in sides)
            for k in range(0, most, 4096):
                flat = (a[k : k + 4096] - b[k : k + 4096]).astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([flat], pa.binary())], ["d"])

    dealt = table.withColumn("copy", F.explode(F.sequence(F.lit(0), more))).repartition(parts, part).select("label", "x")
    return written(dealt.mapInArrow(pair, "d binary"), "quality-pairs"), parts


def _sums(pairs: DataFrame, tasks: int, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logistic loss of all pairs under ``w``, with its gradient and Hessian, added up in a tree of tasks."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + len(w) + len(w) ** 2)
        for batch in batches:
            for flat in batch.column(0).to_pylist():
                d = np.frombuffer(flat, np.float32).reshape(-1, len(w)).astype(float)
                s = d @ w
                wrong = 1 / (1 + np.exp(np.clip(s, -500, 500)))
                slopes = (d * (wrong * (1 - wrong))[:, None]).T @ d
                total += np.concatenate([[len(d), np.logaddexp(0, -s).sum()], -(wrong @ d), slopes.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flats = [np.frombuffer(flat) for batch in batches for flat in batch.column(0).to_pylist()]
        if flats:
            yield pa.RecordBatch.from_arrays([pa.array([sum(flats).tobytes()], pa.binary())], ["s"])

    sums = pairs.mapInArrow(own, "s binary")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(add, "s binary")
    total = sum(np.frombuffer(bytes(r["s"])) for r in sums.collect())
    n, k = max(1.0, total[0]), len(w)
    return total[1] / n, total[2 : 2 + k] / n, total[2 + k :].reshape(k, k) / n


def _weights(pairs: DataFrame, tasks: int, decay: float = 1e-3, most: int = 30) -> np.ndarray:
    """The weights of least loss, with ``decay`` drawing them to 0, by Newton's steps, halved where the loss would rise."""
    w = best = np.zeros(N_FEATURES)
    least, step = np.inf, np.zeros(N_FEATURES)
    for _ in range(most):
        loss, slope, curve = _sums(pairs, tasks, w)
        loss += decay / 2 * (w @ w)
        if loss <= least:
            best, least = w, loss
            step = np.linalg.solve(curve + decay * np.eye(len(w)), slope + decay * w)
        else:
            step = step / 2
        if np.abs(step).max() < 1e-4:
            break
        w = best - step
    return best


def _threshold(table: DataFrame, mean: np.ndarray, deviation: np.ndarray, w: np.ndarray, bad_share: float, good: int, bad: int) -> float:
    """As :func:`fit` has it, over the scores of all rows, counted in at most 65,537 steps of equal width."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((np.clip((_matrix(batch) - mean) / deviation, -8, 8) * w).sum(axis=1), pa.float64())

    width = max(1e-9, 16 * float(np.abs(w).sum()) / 65_536)
    rows = table.select("label", scored("x").alias("s"))
    steps = rows.groupBy(F.floor(F.col("s") / width).alias("step")).agg(
        F.sum(F.when(F.col("label") == 1, (1 - bad_share) / good).otherwise(bad_share / bad)).alias("weight"), F.min("s").alias("low"), F.max("s").alias("high")
    )
    found = sorted((r["low"], r["high"], r["weight"]) for r in steps.collect())
    low, high, weight = (np.array(c) for c in zip(*found))
    if len(low) == 1:
        return float((low[0] + high[0]) / 2)
    upto = np.cumsum(weight)
    near = np.flatnonzero((upto >= 0.8 * bad_share) & (upto <= 1.1 * bad_share))
    near = near[near < len(low) - 1]
    if not len(near):
        near = np.array([min(len(low) - 2, int(np.searchsorted(upto, bad_share)))])
    k = near[np.argmax(low[near + 1] - high[near])]
    return float((high[k] + low[k + 1]) / 2)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of every labelled text outside the fold held out, whole texts of any length.

    The share of label 0 is counted over all labelled rows outside that fold.
    """
    label = F.col(label_col).cast("int")
    seen = labels.where(~is_fold(F.col(id_col), 3, 1)).agg(
        F.count_if(label == 0).alias("bad"), F.count_if(label.isin(0, 1)).alias("all")
    ).first()
    table = _training(docs, labels, id_col, text_col, label_col)
    x = [F.get("x", F.lit(k)) for k in range(N_FEATURES)]
    got = table.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0), *map(F.avg, x), *map(F.stddev_pop, x)).first()
    good, bad = got[:2]
    if not good or not bad:
        return fit(np.zeros((good + bad, N_FEATURES)), [1] * min(1, good) + [0] * min(1, bad), 0.0)
    mean, deviation = np.array(got[2 : 2 + N_FEATURES]), np.array(got[2 + N_FEATURES :]) + 1e-6
    w = _weights(*_pairs(table, mean, deviation, good, bad))
    return Model(mean, deviation, w, _threshold(table, mean, deviation, w, seen["bad"] / max(1, seen["all"]), good, bad))


def with_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least: float = 0.5) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``, learnt from ``labels``.

    Null and empty texts get the score of a text without words, equal texts equal
    scores; rows without an id count as held out; an empty table gives an empty
    result; other columns are not looked at.
    """
    model = learn(docs, labels, id_col, text_col, label_col)
    got = docs.select(
        F.col(id_col).alias("id"),
        is_fold(F.col(id_col), 3, 1).alias("held_out"),
        score(F.col(text_col), model).alias("score"),
    )
    return got.withColumn("predicted", (F.col("score") >= least).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with the columns they came with."""
    model = learn(docs, labels, id_col, text_col, label_col)
    name = free_name(docs, "score")
    return docs.withColumn(name, score(F.col(text_col), model)).where(F.col(name) >= least).drop(name)
