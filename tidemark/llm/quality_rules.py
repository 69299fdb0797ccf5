"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at counts of one document and votes "bad", "good" or abstains; a rule
may well be wrong. A two-class model in which the votes are independent given the
class is fitted by expectation maximisation on the counts of the vote patterns (at
most 3 ** rules rows, whatever the input); a document's verdict is its posterior
probability of the good class. So a bad vote is overruled where the other rules speak
for the document, and several doubtful abstentions can reject one without a bad vote.
Everything on the rows is DataFrame expressions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, let, words, written

BAD, ABSTAIN, GOOD = "b", "-", "g"

#: Counts that ``text_counts`` gives, in order.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_shouts")
#: How many rules vote.
N_RULES = 7


def _repeat_words(words: Column, n: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Where two windows hash alike, all are sorted as hash and place in one long, so
    that equal ones become neighbours; whether neighbours are equal is then decided
    on the words themselves.
    """

    def covered(hashes: Column) -> Column:
        return let(F.ceil(F.log2(n + 1)).cast("int"), lambda bits: let(
            F.call_function("shiftleft", F.lit(-1).cast("long"), bits), lambda high: sorted_places(hashes, high)
        ))

    def sorted_places(hashes: Column, high: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda x, i: x.bitwiseAND(high).bitwiseOR(i.cast("long"))))
        place = lambda x: x.bitwiseAND(F.bitwise_not(high)).cast("int")

        def same(x: Column, y: Column) -> Column:
            near = x.bitwiseXOR(y).bitwiseAND(high) == 0
            equal = [F.get(words, place(x) + k) == F.get(words, place(y) + k) for k in range(3)]
            return F.coalesce(near, F.lit(False)) & equal[0] & equal[1] & equal[2]

        def places(keys: Column) -> Column:
            found = F.filter(keys, lambda x, k: same(x, F.get(keys, k - 1)) | same(x, F.get(keys, k + 1)))
            return F.sort_array(F.transform(found, place))

        def total(at: Column) -> Column:
            steps = F.transform(
                at, lambda x, k: F.least(F.coalesce(F.get(at, k + 1) - x, F.lit(3)), F.lit(3))
            )
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(keys, lambda keys: let(places(keys), total))

    hashes = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    none = F.lit(0).cast("long")
    return F.when(n < 4, none).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))
    )


def text_counts(text: Column) -> Column:
    """A struct of the counts in ``BASE`` and ``MORE`` (long) over the whole text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        n = F.size(words)
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
        return let(
            lines,
            lambda lines: F.struct(
                n.cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeat_words(words, n).alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
                F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
            ),
        )

    return let(words(text), of)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def votes(c: Column) -> Mapping[str, Column]:
    """A vote of each rule, from the counts ``c``; without a word all rules but the length abstain.

    Each rule has a view of its own: length, symbols, capitals, exclamation marks,
    repeated word windows, repeated lines, and the length of words.
    """

    def rule(bad: Column, good: Column | None = None) -> Column:
        vote = F.when(bad, F.lit(BAD))
        return F.coalesce(vote if good is None else vote.when(good, F.lit(GOOD)), F.lit(ABSTAIN))

    n, chars = c["n_words"], F.nullif(c["word_chars"], F.lit(0))
    several = c["n_lines"] > 3
    return {
        "length": rule(n < 80, n >= 120),
        "symbols": rule(c["n_symbols"] > 0.1 * n, c["n_symbols"] <= 0.01 * n),
        "upper": rule(c["n_upper"] / chars > 0.12, c["n_upper"] / chars < 0.1),
        "shouts": rule(c["n_shouts"] > 0.1 * n, c["n_shouts"] <= 0.02 * n),
        "repeats": rule(c["n_repeat_words"] > 0.3 * n, c["n_repeat_words"] <= 0.1 * n),
        "lines": rule(several & (c["n_dup_lines"] > 0.3 * c["n_lines"]), several & (c["n_dup_lines"] == 0)),
        "word_length": rule((chars / n < 4.2) | (chars / n > 7), (chars / n >= 4.6) & (chars / n <= 6.3)),
    }


def fit(
    patterns: Mapping[str, int],
    n_rules: int,
    iterations: int = 60,
    good_strength: float = 0.01,
    bad_strength: float = 0.1,
) -> tuple[float, list[dict[str, float]]]:
    """EM over pattern counts: log odds of the good class, and for each rule its log ratio by vote.

    Documents begin as good with a probability of 0.97 if no rule says bad, 0.8 if one
    does, and 0.05 if several rules agree on it. A prior, whose weight is a share of all
    documents, says that good documents get few bad votes and bad ones many. It weighs
    more for the bad class: that stays the class of bad votes also where there are few
    bad documents, in place of becoming any smaller group of good ones.
    """
    total = float(sum(patterns.values())) or 1.0
    prior = {True: {BAD: 0.05, ABSTAIN: 0.35, GOOD: 0.6}, False: {BAD: 0.4, ABSTAIN: 0.3, GOOD: 0.3}}
    belief = {p: {0: 0.97, 1: 0.8}.get(p.count(BAD), 0.05) for p in patterns}
    odds, ratios = 0.0, []
    for _ in range(iterations):
        weight = {
            good: sum(n * (belief[p] if good else 1 - belief[p]) for p, n in patterns.items())
            for good in (True, False)
        }
        odds = math.log((weight[True] + 1) / (weight[False] + 1))
        ratios = []
        for k in range(n_rules):
            share = {}
            for good in (True, False):
                seen = dict.fromkeys((BAD, ABSTAIN, GOOD), 0.0)
                for p, n in patterns.items():
                    seen[p[k]] += n * (belief[p] if good else 1 - belief[p])
                extra = (good_strength if good else bad_strength) * total
                share[good] = {
                    v: (seen[v] + extra * prior[good][v]) / (weight[good] + extra) for v in seen
                }
            ratios.append({v: math.log(share[True][v] / share[False][v]) for v in share[True]})
        belief = {
            p: 1 / (1 + math.exp(-max(-500.0, min(500.0, odds + sum(r[v] for r, v in zip(ratios, p))))))
            for p in patterns
        }
    return odds, ratios


def posterior(vote_cols: Sequence[Column], odds: float, ratios: Sequence[Mapping[str, float]]) -> Column:
    """Probability of the good class given the votes."""
    total = F.lit(float(odds))
    for vote, ratio in zip(vote_cols, ratios):
        total = total + F.when(vote == BAD, ratio[BAD]).when(vote == GOOD, ratio[GOOD]).otherwise(ratio[ABSTAIN])
    return 1 / (1 + F.exp(-total))


def with_verdicts(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with the counts of :func:`text_counts`, ``base_failed``, ``p_quality`` and ``kept``.

    A null text counts as empty: no words, so the base test fails. Repeated rows are
    judged alike; an empty table gives an empty result. New columns take the place of
    columns of the same names; all others stay, whatever their names. The rows with
    their counts are written to the shared folder once, and read for the fit and the
    verdict; :func:`verdicts` writes the counts alone.
    """
    counts = free_name(docs, "counts")
    table = written(docs.withColumn(counts, text_counts(F.col(f"`{text_col}`"))), "quality-rules")
    return _judged(table, counts, least).drop(counts)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id, the counts of ``BASE``, base_failed, p_quality, kept) for each row of ``docs``; cases as above."""
    counts = docs.select(F.col(f"`{id_col}`").alias("id"), text_counts(F.col(f"`{text_col}`")).alias("counts"))
    return _judged(written(counts, "quality-rules"), "counts", least).drop("counts")


def _judged(table: DataFrame, counts: str, least: float) -> DataFrame:
    """``table`` with the counts and what they lead to, learnt from the patterns of all rows."""
    cast = list(votes(F.col(counts)).values())
    pattern = F.concat(*cast).alias("p")
    seen = {r["p"]: r["n"] for r in table.groupBy(pattern).agg(F.count("*").alias("n")).collect()}
    odds, ratios = fit(seen, N_RULES)
    failed = base_failed(F.col(counts))
    good = posterior(cast, odds, ratios)
    new = {k: F.col(counts)[k] for k in BASE} | {
        "base_failed": failed,
        "p_quality": good,
        "kept": ~failed & (good >= least),
    }
    return table.withColumns(new)


def keep_good(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns they came with.

    Counts are written with 128 bits that tell the text, not the texts themselves; the
    rows of the texts that are rejected are then left out.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    one, two = free_name(docs, "text_one"), free_name(docs, "text_two")
    place = {one: F.xxhash64(text), two: F.xxhash64(F.lit(1), text)}
    counted = docs.select(*(h.alias(name) for name, h in place.items()), text_counts(text).alias("counts"))
    judged = _judged(written(counted, "quality-rules"), "counts", least)
    gone = written(judged.where(~F.col("kept")).select(one, two).distinct(), "quality-rules")
    gone = F.broadcast(gone) if gone.limit(1_000_001).count() <= 1_000_000 else gone  # 16 bytes each
    return docs.withColumns(place).join(gone, [one, two], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
