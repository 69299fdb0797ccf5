from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import TESTDATA
from tests.llm import cases
from tidemark.llm import langid, ngrams, quality_rank, toxicity
from tidemark.llm.labelled import sample


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def corpus(n=400):
    """Invented documents: toxic ones hold one of two stems, bad ones are cries or signs."""
    rng = random.Random(5)
    syllables = ["ba", "to", "ri", "ne", "ka", "lu", "mo", "si", "de", "fa"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(60, 120))]
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zorgh", "vilx"]) + rng.choice(syllables)
        if bad:
            words = [w.upper() + "!!" if i % 2 else w + "***" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    labels += [(None, 1, 1), (5, None, None), (99999, 0, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: (q, t) for i, q, t in labels[:400]},
    )


def held_out_accuracy(got, truth):
    pairs = [(r["predicted"], truth[r["id"]]) for r in got if r["held_out"]]
    return sum(p == t for p, t in pairs) / len(pairs)


def test_toxicity_on_the_fold_held_out(tables):
    docs, labels, truth = tables
    got = toxicity.with_toxicity(docs, labels).collect()
    assert all(r["held_out"] == held(r["id"]) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert held_out_accuracy(got, {i: t for i, (_, t) in truth.items()}) >= 0.97


def test_quality_on_the_fold_held_out(tables):
    docs, labels, truth = tables
    got = quality_rank.with_quality(docs, labels).collect()
    assert all(r["held_out"] == held(r["id"]) and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert held_out_accuracy(got, {i: q for i, (q, _) in truth.items()}) == 1
    kept = {r["doc_id"] for r in quality_rank.keep_good(docs, labels).collect()}
    assert kept == {r["id"] for r in got if r["predicted"]}


def test_quality_is_learnt_from_long_texts_too(spark):
    """All bad texts are above 16,384 bytes: no bound on what is learnt from may leave them out."""
    texts = {i: "good words in a row here " * 900 if i % 3 else "BAD!! CRIES!! " * 1500 for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in texts], "doc_id long, quality int")
    got = quality_rank.with_quality(docs, labels).collect()
    assert {(r["predicted"], int(r["id"] % 3 != 0)) for r in got} == {(0, 0), (1, 1)}


def test_every_row_is_in_a_pair(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "PER_TASK", 16)
    monkeypatch.setattr(quality_rank, "FEWEST", 4)
    n = quality_rank.N_FEATURES
    rows = [(i, int(i >= 3), [float(i if i >= 3 else 0)] + [0.0] * (n - 1)) for i in range(100)]  # 3 bad ones for 7 tasks
    table = spark.createDataFrame(rows, "h long, label int, x array<double>").repartition(5)
    pairs, tasks = quality_rank._pairs(table, np.zeros(n), np.full(n, 100.0), 97, 3)
    found = np.concatenate([np.frombuffer(bytes(r["d"]), np.float32).reshape(-1, n) for r in pairs.collect()])[:, 0]
    assert tasks == 7 and set(np.round(found * 100).astype(int)) == set(range(3, 100))
    loss, slope, curve = quality_rank._sums(pairs, tasks, np.zeros(n))
    assert loss == pytest.approx(np.log(2)) and slope[0] == pytest.approx(-found.mean() / 2, rel=1e-4) and curve[0, 0] > 0


def test_labels_of_the_fold_held_out_are_never_learnt(tables, spark):
    docs, labels, _ = tables
    rows = sample(docs, labels, "toxic", 1000, 10000)
    texts = {t for t, _ in rows}
    known = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert texts and all(not held(i) for i, t in known.items() if t in texts)
    assert len(sample(docs, labels, "toxic", 7, 10000)) == 14
    assert all(len(t.encode()) <= 300 for t, _ in sample(docs, labels, "toxic", 1000, 300))


def test_classifiers_take_odd_rows(spark, tables):
    _, labels, _ = tables
    for learn in (toxicity.with_toxicity, quality_rank.with_quality):
        for rows in (labels, labels.where("false"), labels.where("toxic = 0 and quality = 1")):
            got = learn(cases.odd(spark), rows)
            scores = [(r["id"], r["score"]) for r in got.collect()]
            assert len(scores) == len(cases.odd_rows()) and all(0 <= s <= 1 for _, s in scores)
            assert len({s for i, s in scores if i in (3, 4)}) == 1  # null and empty are alike
            assert learn(cases.none(spark), rows).count() == 0
    kept = quality_rank.keep_good(cases.odd(spark), labels)
    assert kept.columns == cases.odd(spark).columns


def test_bigger_scores_for_the_better_of_a_pair():
    texts = ["good words in a row here"] * 5 + ["bad! bad! bad!"] * 5
    x = quality_rank.features(pa.array(texts))
    model = quality_rank.fit(x, [1] * 5 + [0] * 5, 0.5, pairs=100, rounds=50)
    s = quality_rank.scores(pa.array(texts), model)
    assert s[:5].min() > 0.5 > s[5:].max()


def test_grams_stay_in_their_text():
    texts = ["abcdef", "", None, "ab", "ABCDEF", "äöü🙂x"]
    alone = [[c.tolist() for c in next(ngrams.grams(pa.array([t], pa.string()), (2, 4), 12))[1]] for t in texts]
    together = [[c.tolist() for c in codes] for _, codes in ngrams.grams(pa.array(texts), (2, 4), 12)]
    assert alone == together
    assert together[0] == together[4] and [len(c) for c in together[5]] == [4, 2] and together[1] == together[2] == [[], []]


def test_a_bucket_counts_once():
    weights = np.zeros(1 << toxicity.BITS)
    weights[next(ngrams.grams(pa.array(["abcd"]), (4,), toxicity.BITS))[1][0]] = 2.0
    one, many, none = toxicity.scores(pa.array(["abcd", "abcd abcd abcd", None]), weights, 0.0)
    assert one == many == 1 / (1 + np.exp(-2)) and none == 0.5


LANGUAGES = {"aa": ["ba", "to", "ri", "ne"], "bb": ["xu", "wy", "qo", "zz"], "cc": ["ñe", "ür", "êm", "çi"]}


def language_rows(n=240):
    rng = random.Random(2)
    names = sorted(LANGUAGES)
    return [
        (i, " ".join("".join(rng.choices(LANGUAGES[names[i % 3]], k=3)) for _ in range(rng.randint(1, 60))), names[i % 3]) for i in range(n)
    ]


def test_language_on_the_fold_held_out(spark):
    rows = language_rows()
    got = langid.with_language(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {i: name for i, _, name in rows}
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == held(r["id"]) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["lang_pred"] == truth[r["id"]] for r in out) >= 0.98 * len(out)


def test_language_of_odd_rows(spark):
    rows = [(*r[:2], r[2], *r[3:]) for r in cases.odd_rows()]
    got = langid.with_language(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    und = [r for r in got if r["lang_pred"] == "und"]
    assert sorted(str(r["id"]) for r in und) == sorted(["3", "4", "5", "None"]) and all(r["score"] == 0 and r["rejected"] for r in und)
    assert {r["lang_pred"] for r in got} <= {"en", "de", "xx", "und"}
    assert langid.with_language(cases.none(spark)).count() == 0
    nothing = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.with_language(nothing).collect()] == ["und"]
    digits = spark.createDataFrame([(1, "12 34!", "en"), (2, "words", "en")], "doc_id long, text string, lang string")
    assert {r["id"]: r["lang_pred"] for r in langid.with_language(digits).collect()}[1] == "und"


def test_language_samples_leave_the_fold_out(spark):
    rows = language_rows(60)
    texts = {t: i for i, t, _ in rows}
    got = langid.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", 5, 8192)
    assert len(got) == 15 and not any(held(texts[t]) for t, _ in got)


def test_languages_of_long_texts_only_and_of_one_text_are_learnt(spark):
    outside = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1]
    long = [(i, f"zyx wvu {i} " * (1000 + k), "long") for k, i in enumerate(outside[:20])]  # all above 8,192 bytes
    many = [(i, f"word{k} text{k} again{k}", f"l{k:03d}") for k, i in enumerate(outside[100:220])]  # more than 50
    frame = spark.createDataFrame(long + many, "doc_id long, text string, lang string")
    got = langid.sample(frame, "doc_id", "text", "lang", 2, 8192)
    assert {name for _, name in got} == {"long", *(name for _, _, name in many)}
    assert [t for t, name in got if name == "long"] == [long[0][1]]
    assert {r["lang_pred"] for r in langid.with_language(frame).collect() if r["id"] in outside[:20]} == {"long"}


# Features and scores against plain Python, and the given tables


def bucket(gram, bits):
    """The bucket of one n-gram, a code point after the other."""
    low = lambda c: ord(c.lower()) if len(c.lower()) == 1 and ord(c) < 1 << 16 else ord(c)
    code = (low(gram[0]) * 0x01000193 + len(gram)) & 0xFFFFFFFF
    for c in gram[1:]:
        code ^= code >> 15
        code = (code * 0x01000193 + low(c)) & 0xFFFFFFFF
    code ^= code >> 16
    return (code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)


def buckets(text, lengths, bits):
    return [bucket(text[i : i + n], bits) for n in lengths for i in range(len(text) - n + 1)]


TEXTS = ["The Üble idea, again and again! and again", "", "abc", "ñandú 🙂🙂 x\ty", "ALL caps #### 12 34\nline two\n\nend.", "word " * 300]


def test_toxicity_scores_are_sums_over_distinct_grams():
    rng = np.random.default_rng(1)
    weights = rng.standard_normal(1 << toxicity.BITS)
    got = toxicity.scores(pa.array(TEXTS), weights, -0.25)
    for text, score in zip(TEXTS, got):
        z = -0.25 + sum(weights[b] for b in set(buckets(text, toxicity.LENGTHS, toxicity.BITS)))
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -500, 500))), abs=1e-9)


def test_evidence_is_the_likelihood_ratio():
    def log_likelihood(hits, of):
        p = hits / of
        return sum(n * np.log(x) for n, x in ((hits, p), (of - hits, 1 - p)) if n)

    cases_of = [(5, 0), (0, 7), (10, 40), (30, 70), (1, 1)]
    ones, zeros = (np.array(x, float) for x in zip(*cases_of))
    got = toxicity.evidence(ones, zeros, 30.0, 70.0)
    for (a, b), g in zip(cases_of, got):
        assert g == pytest.approx(2 * (log_likelihood(a, 30) + log_likelihood(b, 70) - log_likelihood(a + b, 100)), abs=1e-9)


def test_weights_are_those_of_scaled_features():
    """Only buckets with evidence have a weight, with the sign of their log-count ratio."""
    texts = [f"text {i} zorgh here" for i in range(20)] + [f"text {i} calm here" for i in range(20)]
    weights, _ = toxicity.fit(texts, [1] * 20 + [0] * 20)
    used = set(np.flatnonzero(weights).tolist())
    having = [set(buckets(t, toxicity.LENGTHS, toxicity.BITS)) for t in texts]
    assert used <= set().union(*having) and used
    for b in used:
        ones, zeros = sum(b in h for h in having[:20]), sum(b in h for h in having[20:])
        assert ones + zeros >= 3 and (weights[b] > 0) == (ones > zeros)
    assert bucket("zorg", toxicity.BITS) in used and bucket("text", toxicity.BITS) not in used


def test_toxicity_on_the_given_table(spark):
    """Held out, sf0.1: at least three quarters of the toxic documents, next to no other."""
    sf = TESTDATA / "sf0.1"
    docs, labels = (spark.read.parquet(str(sf / f"{t}.parquet")) for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    only = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = [(r["predicted"], truth[r["id"]]) for r in toxicity.with_toxicity(only, labels).collect() if r["held_out"]]
    toxic, others = [p for p, t in got if t], [p for p, t in got if not t]
    assert sum(toxic) >= 0.75 * len(toxic) and sum(others) <= 0.01 * len(others)


def test_quality_features_against_plain_python():
    got = quality_rank.features(pa.array(TEXTS))
    for text, row in zip(TEXTS, got):
        data, words = text.encode(), cases.words(text)
        size, some = max(1, len(data)), max(1, len(words))
        raw = [w.encode() for w in words]
        expected = [data.count(bytes([c])) / size for c in quality_rank.SIGNS]
        expected += [sum(a <= c <= b for c in data) / size for a, b in ((65, 90), (97, 122), (48, 57), (128, 255), (10, 10), (32, 32))]
        expected += [np.log1p(len(words)) / 10, sum(map(len, raw)) / some / 10]
        expected += [sum(words[i] == words[i - k] for i in range(k, len(words))) / some for k in (1, 2)]
        expected += [sum(w[-1:] in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!") for w in raw) / some]
        expected += [np.sqrt(len(set(words)) / some), float(len(words) < 50)]
        assert row == pytest.approx(expected, abs=1e-9)
    model = quality_rank.Model(np.full(quality_rank.N_FEATURES, 0.1), np.full(quality_rank.N_FEATURES, 0.5), np.linspace(-1, 1, quality_rank.N_FEATURES), 0.2)
    z = [sum(w * max(-8, min(8, (x - 0.1) / 0.5)) for x, w in zip(row, model.weights)) - 0.2 for row in got]
    assert quality_rank.scores(pa.array(TEXTS), model) == pytest.approx([1 / (1 + np.exp(-s)) for s in z], abs=1e-9)


def test_language_scores_are_averages_over_grams():
    rng = np.random.default_rng(4)
    model = langid.Model(["a", "b", "c"], rng.standard_normal((1 << langid.BITS, 3)).astype(np.float32), rng.standard_normal(3).astype(np.float32), 0.7, 0.5)
    best, p = langid.predict(pa.array(TEXTS), model)
    for text, k, score in zip(TEXTS, best, p):
        own = buckets(text, langid.LENGTHS, langid.BITS)
        z = sum((model.logits[b].astype(float) for b in own), np.zeros(3)) / max(1, len(own))
        chance = np.exp((z + model.bias) / model.temperature)
        chance /= chance.sum()
        assert k == chance.argmax() and score == pytest.approx(chance.max(), abs=1e-6)
