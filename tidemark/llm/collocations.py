"""Phrase mining: frequent neighbours counted in tiles of frequency-ranked ids.

Words are counted first. The most frequent ones get ids by their rank, so that pairs
of ids gather in few tiles of 2,048 x 2,048: a task counts a full tile with a dense
``bincount``, the sparse ones as sorted codes with counts (COO). Pairs that turn out
frequent are ranked in turn, and triples are counted as pairs of a pair's id and a
word's in the same way. Words and pairs beyond the ids that go to every task are
counted by their hashes, as sorted rows; so the number of ids changes the cost and no
result. Pairs of ids travel as one number. A part of a frequent phrase is frequent, so a bitmap of fixed size leaves out
most of the rare words and pairs; those it lets pass are counted and then dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, join_few, lean, most_common, tidied, written
from .terms import joined
from .word_hashes import hashes, lowered, mix, spans

#: What stands between pieces, and between words of a piece.
_BETWEEN_PIECES = np.zeros(256, bool)
_BETWEEN_PIECES[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BETWEEN_PIECES.copy()
_APART[[0x20, 0x09]] = True

#: Words, and pairs, that have an id in every task; bits of an id within a tile.
IDS, INNER = 1 << 20, 11
#: Pairs that a task counts at once, distinct ones that it holds, and from how many on a tile is counted densely.
AT_ONCE, HELD, DENSE = 1 << 22, 1 << 21, 1 << 18
#: Bits of the map of hashes that can be frequent.
MAP_BITS = 27

_A, _B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _A ^ mix(b + _B))


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``keys`` in order, and their counts added up; the list ``keys`` is used up."""
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in range(len(keys)):  # one after the other, so that a key's former order is free before the next one's
        keys[k] = keys[k][order]
        new[1:] |= keys[k][1:] != keys[k][:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts[order], first)


class Rows:
    """Rows of hashes with counts, added up while they are held: the form of what has no id."""

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts = [np.zeros(0, np.uint64)] * self.width, np.zeros(0, np.int64)
        self.more: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, *keys: np.ndarray) -> bool:
        """Whether so many distinct rows are held that they should be handed on."""
        self.more.append(list(keys))
        self.waiting += len(keys[0])
        if self.waiting >= AT_ONCE:
            self._merge()
        return len(self.counts) >= HELD

    def _merge(self) -> None:
        counts = np.concatenate([self.counts, np.ones(self.waiting, np.int64)])
        parts = [self.keys, *self.more]
        self.clear()
        every = []
        for k in range(self.width):
            every.append(np.concatenate([p[k] for p in parts]))
            for p in parts:
                p[k] = None  # it is in ``every`` now
        self.keys, self.counts = _summed(every, counts)

    def take(self) -> tuple[list[np.ndarray], np.ndarray]:
        self._merge()
        out = self.keys, self.counts
        self.clear()
        return out


class Tiles:
    """Counts of pairs of ids below ``IDS``, by tiles."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.more: list[np.ndarray] = []
        self.waiting = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether so many distinct pairs are held that they should be handed on."""
        low = (1 << INNER) - 1
        outer = 20 - INNER  # bits of a tile's number in each direction
        tile = (a >> INNER) << outer | b >> INNER
        self.more.append(tile << 2 * INNER | (a & low) << INNER | b & low)
        self.waiting += len(a)
        if self.waiting >= AT_ONCE:
            self._merge()
        return len(self.codes) >= HELD

    def _merge(self) -> None:
        if not self.waiting:
            return
        codes = np.concatenate(self.more)
        self.more, self.waiting = [], 0
        area = 1 << 2 * INNER
        tiles, counts = [], []
        tile = (codes >> 2 * INNER).astype(np.int32)
        full = np.bincount(tile) >= DENSE
        for t in np.flatnonzero(full).tolist():
            seen = np.bincount(codes[tile == t] & (area - 1), minlength=area)
            at = np.flatnonzero(seen)
            tiles.append(t << 2 * INNER | at)
            counts.append(seen[at])
        codes = codes[~full[tile]] if full.any() else codes
        del tile
        sparse, often = np.unique(codes, return_counts=True)
        del codes
        keys, counts = [np.concatenate([self.codes, *tiles, sparse])], np.concatenate([self.counts, *counts, often])
        (self.codes,), self.counts = _summed(keys, counts)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of pairs, in order, and how often they were added."""
        self._merge()
        codes, counts = self.codes, self.counts
        self.clear()
        return codes, counts


def ids_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two ids of each code of :class:`Tiles`."""
    low, outer = (1 << INNER) - 1, 20 - INNER
    tile = codes >> 2 * INNER
    return (tile >> outer) << INNER | codes >> INNER & low, (tile & (1 << outer) - 1) << INNER | codes & low


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """By blocks of the texts of ``batch`` (lang, text): lower-case bytes, each word's begin, end, hash with its
    language, and piece, and the language's number in ``langs``, which comes first."""
    langs = batch.column(0).dictionary_encode()
    names = langs.dictionary.to_pylist()
    data, offsets = joined(x.encode() for x in names)
    own = hashes(data, offsets[:-1], offsets[1:])
    lang = np.asarray(langs.indices)
    for first, last, raw, offsets in blocks(batch.column(1)):
        data = lowered(raw)
        starts, ends, number = spans(data, offsets, _APART)
        text = np.repeat(np.arange(last - first), np.diff(number))
        of = lang[first:last][text]
        code = mix(hashes(data, starts, ends) + own[of] * _A) if len(names) else np.zeros(0, np.uint64)
        piece = np.cumsum(_BETWEEN_PIECES[data])[starts] + text if len(starts) else starts
        same = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        yield names, data, starts, ends, code, of, same


def _word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, h, c), written: the occurrences of each word of ``texts`` (lang, text)."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[str, bytes]] = {}
        codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            named = [held[h] for h in codes.tolist()]
            columns = [pa.array([x for x, _ in named], pa.string()), pa.array([w for _, w in named], pa.binary()).cast(pa.string())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(codes.view(np.int64)), pa.array(counts)], ["lang", "word", "h", "c"])

        for batch in batches:
            for names, data, starts, ends, code, of, _ in _words(batch):
                new, at, often = np.unique(code, return_index=True, return_counts=True)
                raw = data.tobytes()
                unseen = ~np.isin(new, codes)
                for h, a, b, k in zip(new[unseen].tolist(), starts[at[unseen]].tolist(), ends[at[unseen]].tolist(), of[at[unseen]].tolist()):
                    held[h] = names[k], raw[a:b]
                (codes,), counts = _summed([np.concatenate([codes, new])], np.concatenate([counts, often]))
                if len(codes) >= HELD // 4:
                    yield out()
                    held, codes, counts = {}, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(codes):
            yield out()

    got = texts.mapInArrow(count, "lang string, word string, h long, c long")
    return written(got.groupBy("lang", "word", "h").agg(F.sum("c").alias("c")), "phrase-words")


def _bitmap(rows: DataFrame, h: Column) -> np.ndarray:
    """A byte array of ``MAP_BITS`` bits with those of the hashes ``h`` set; put together by Spark, of a fixed size."""
    place = F.shiftrightunsigned(h, 64 - MAP_BITS + 5)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, 64 - MAP_BITS) % 32).cast("int"))
    masks = rows.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("mask")).toArrow()
    out = np.zeros(1 << MAP_BITS - 5, np.uint32)
    out[masks["place"].to_numpy()] = masks["mask"].to_numpy().astype(np.uint32)
    return out


def _can_be(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = (h >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return bitmap[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1) == 1


class Ranked:
    """Ids, by frequency, of the most frequent hashes."""

    def __init__(self, frequent: DataFrame, ids: int):
        top = most_common(frequent, min(ids, IDS))
        h, c = (top[x].to_numpy().astype(np.int64) for x in ("h", "c"))
        self.h = h[np.lexsort((h, -c))].view(np.uint64)  # by id
        self.least = int(c.min()) if len(c) else 0
        self.rank = np.argsort(self.h)
        self.codes = self.h[self.rank]

    def find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.codes, h), len(self.codes) - 1)
        return np.where(self.codes[at] == h, self.rank[at], -1)


def _handed(keys: list[np.ndarray], counts: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``width`` keys and the count; a code is a row's first key, the others null."""
    names = ["a", "b", "d"][:width] + ["c"]
    for at in range(0, len(counts), 1 << 16):
        part = slice(at, at + (1 << 16))
        columns = [pa.array(k[part].view(np.int64)) for k in keys]
        columns += [pa.nulls(len(counts[part]), pa.int64())] * (width - len(keys))
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[part])], names)


def _named(batch: pa.RecordBatch, ends: list[np.ndarray], last: np.ndarray) -> list[np.ndarray]:
    """The words' hashes of rows of codes or hashes (and the count): a code's first id stands for ``ends``, its second for ``last``."""
    keys = [np.asarray(c.fill_null(0)).view(np.uint64).copy() for c in batch.columns[:-1]]
    coded = np.asarray(batch.column(1).is_null())
    first, second = ids_of(keys[0][coded].view(np.int64))
    for key, of in zip(keys, [*(end[first] for end in ends), last[second]]):
        key[coded] = of
    return keys


def _frequent_pairs(texts: DataFrame, words: DataFrame, least: int, ids: int) -> DataFrame:
    """(a, b, c, h), written: two words' hashes, how often one follows the other, from ``least`` on, and the pair's hash."""
    sent = texts.sparkSession.sparkContext.broadcast((Ranked(words, ids), _bitmap(words, F.col("h"))))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, bitmap = sent.value
        tiles, rows = Tiles(), Rows(2)

        def taken() -> Iterator[pa.RecordBatch]:
            codes, counts = tiles.take()
            yield from _handed([codes], counts, 2)

        for batch in batches:
            for *_, h, _, same in _words(batch):
                often = _can_be(bitmap, h)
                first = np.flatnonzero(same & often[1:] & often[:-1])
                number = ranked.find(h)
                known = (number[first] >= 0) & (number[first + 1] >= 0)
                if tiles.add(number[first[known]], number[first[known] + 1]):
                    yield from taken()
                if rows.add(h[first[~known]], h[first[~known] + 1]):
                    yield from _handed(*rows.take(), 2)
        yield from taken()
        yield from _handed(*rows.take(), 2)

    @lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, _ = sent.value
        for batch in batches:
            keys = _named(batch, [ranked.h], ranked.h)
            columns = [pa.array(k.view(np.int64)) for k in (*keys, _pair_hash(*keys))]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2)], ["a", "b", "h", "c"])

    got = texts.mapInArrow(count, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    return written(got.mapInArrow(name, "a long, b long, h long, c long"), "phrase-pairs")


def _frequent_triples(texts: DataFrame, words: DataFrame, pairs: DataFrame, least: int, ids: int) -> DataFrame:
    """(a, b, d, c), written: three words' hashes, and how often they stand in a row, from ``least`` on."""
    ranked_pairs = Ranked(pairs, ids)
    ends = np.zeros((2, len(ranked_pairs.h)), np.uint64)  # the words of each pair that has an id
    if len(ranked_pairs.h):
        own = pairs.where(F.col("c") >= ranked_pairs.least).select("h", "a", "b").toArrow()
        number = ranked_pairs.find(own["h"].to_numpy().view(np.uint64))
        for k, side in enumerate("ab"):
            ends[k, number] = own[side].to_numpy().view(np.uint64)
    sent = texts.sparkSession.sparkContext.broadcast((Ranked(words, ids), ranked_pairs, ends, _bitmap(pairs, F.col("h"))))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, ranked_pairs, ends, bitmap = sent.value
        tiles, rows = Tiles(), Rows(3)

        def taken() -> Iterator[pa.RecordBatch]:
            codes, counts = tiles.take()
            yield from _handed([codes], counts, 3)

        for batch in batches:
            for *_, h, _, same in _words(batch):
                pair = _pair_hash(h[:-1], h[1:])
                often = same & _can_be(bitmap, pair)
                first = np.flatnonzero(often[1:] & often[:-1])
                number, last = ranked_pairs.find(pair[first]), ranked.find(h[first + 2])
                known = (number >= 0) & (last >= 0)
                known[known] = (ends[0][number[known]] == h[first[known]]) & (ends[1][number[known]] == h[first[known] + 1])
                if tiles.add(number[known], last[known]):
                    yield from taken()
                rest = first[~known]
                if rows.add(h[rest], h[rest + 1], h[rest + 2]):
                    yield from _handed(*rows.take(), 3)
        yield from taken()
        yield from _handed(*rows.take(), 3)

    @lean
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked, _, ends, _ = sent.value
        for batch in batches:
            keys = _named(batch, [*ends], ranked.h)
            yield pa.RecordBatch.from_arrays([*(pa.array(k.view(np.int64)) for k in keys), batch.column(3)], ["a", "b", "d", "c"])

    got = texts.mapInArrow(count, "a long, b long, d long, c long").groupBy("a", "b", "d").agg(F.sum("c").alias("c"))
    return written(got.where(F.col("c") >= least).mapInArrow(name, "a long, b long, d long, c long"), "phrase-triples")


def _score(a: str, left: str, right: str) -> Column:
    wide = {x: f"cast({x} as decimal(19,0))" for x in (a, left, right)}
    return F.expr(f"({wide[a]} * {wide[a]} * cast(1000000 as decimal(7,0))) div ({wide[left]} * {wide[right]})")


@tidied
def phrases(
    docs: DataFrame, most: int = 2000, least: int = 10, ids: int = IDS, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of two and three words of each language.

    Texts, A-Z lower-cased, are split into pieces at . , ; : ! ? and line ends, these
    at spaces and tabs into words; a language is null's (``und``) or a value's. A
    phrase occurs ``a`` times, at least ``least``, in pieces of its language, overlaps
    included, its parts ``l`` and ``r`` times, and all words ``n`` times. It is cut
    where floor(1,000,000 * a * a / (l * r)), its score, is lowest, first of such. Pairs inside
    a triple that occurs half as often or more are left out. Null and empty texts have
    no words; texts are taken whole; rows that repeat count each; an empty table gives
    an empty result; other columns are not looked at. ``ids`` words and pairs at most,
    some 16 bytes each, go to every task.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.octet_length("text") > 0)
    counts = _word_counts(texts)
    words = written(counts.where(F.col("c") >= least), "phrase-frequent")
    pairs = _frequent_pairs(texts, words, least, ids)
    triples = _frequent_triples(texts, words, pairs, least, ids)

    few = written(words.select(F.col("h").alias("a"), "lang", F.col("word").alias("wa"), F.col("c").alias("fa")), "phrase-sides")
    named = join_few(pairs.drop("h"), few, ["a"], most=300_000, salts=8)
    few = written(words.select(F.col("h").alias("b"), F.col("word").alias("wb"), F.col("c").alias("fb")), "phrase-sides")
    named = written(join_few(named, few, ["b"], most=300_000, salts=8), "phrase-named")

    inside = triples.select("a", "b", "c").unionByName(triples.select(F.col("b").alias("a"), F.col("d").alias("b"), "c"))
    longer = inside.groupBy("a", "b").agg(F.max("c").alias("longer"))
    two = named.join(longer, ["a", "b"], "left").where("longer is null or 100 * longer < 50 * c")
    two = two.select("lang", F.concat_ws(" ", "wa", "wb").alias("phrase"), F.col("c").alias("a"), F.col("fa").alias("l"), F.col("fb").alias("r"))
    two = two.withColumn("score", _score("a", "l", "r"))

    head = named.select("a", "b", "lang", "wa", "wb", "fa", F.col("c").alias("fab"))
    tail = named.select(F.col("a").alias("b"), F.col("b").alias("d"), F.col("wb").alias("wd"), F.col("fb").alias("fd"), F.col("c").alias("fbd"))
    three = triples.join(head, ["a", "b"]).join(tail, ["b", "d"])
    three = three.withColumn("s1", _score("c", "fa", "fbd")).withColumn("s2", _score("c", "fab", "fd"))
    second = F.col("s2") < F.col("s1")
    three = three.select(
        "lang",
        F.concat_ws(" ", "wa", "wb", "wd").alias("phrase"),
        F.col("c").alias("a"),
        F.when(second, F.col("fab")).otherwise(F.col("fa")).alias("l"),
        F.when(second, F.col("fd")).otherwise(F.col("fbd")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    order = F.desc("score"), F.desc("a"), F.col("phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))  # a language's best come from 64 parts, so none is sorted in one task
    some = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    best = two.unionByName(three).withColumn("rank", some).where(F.col("rank") <= most)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    sizes = written(counts.groupBy("lang").agg(F.sum("c").alias("n")), "phrase-sizes")
    got = join_few(best, sizes, ["lang"])
    return got.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
