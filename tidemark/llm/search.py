"""Ranked lexical search, a term at a time with a limited number of accumulators.

The documents' terms that a block of items asks for are written once, a row a
document. Tasks then invert blocks of these rows and take each item's terms from the
rarest to the most frequent. An accumulator is begun for every new document until
what the remaining terms can add at most is below the k-th best partial score; from
there on only the documents met so far are updated, exactly, as long as they can
still be among the k best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, tidied, written
from .terms import Vocabulary, lists, terms_of

#: Bytes of items that are taken at once (one item is never cut), and blocks numbered by one task.
ITEM_BYTES, BLOCKS_A_TASK = 4 << 20, 64
#: Postings, or documents, that a task inverts at once (one document is never cut).
POSTINGS, DOCUMENTS = 1 << 20, 1 << 14
_LAST = int(np.iinfo(np.int64).max)

_FOUND = "item int, item_id long, doc_id long, score long"


def _item_blocks(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, text, part), written: parts of about ``ITEM_BYTES``, numbered by as many tasks as the bytes need."""
    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    rows = written(rows.where("octet_length(text) > 0").withColumn("row", F.monotonically_increasing_id()), "search-items")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    own = F.pmod(F.xxhash64("row"), F.lit(total // (ITEM_BYTES * BLOCKS_A_TASK) + 1))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy(own).orderBy("row"))
    before = F.floor((upto - F.octet_length("text")) / ITEM_BYTES)
    return written(rows.select("item_id", "text", F.struct(own.alias("a"), before.alias("b")).alias("part")), "search-parts")


def postings(docs: DataFrame, words: Sequence[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, tfs) of each of ``docs``, written: its number of terms, and the given ones in it with their occurrences."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(Vocabulary(words))
    size = max(1, len(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column(1), 1 << 22):
                term, place = known.find(data, offsets)
                n = np.diff(place)
                doc = np.repeat(np.arange(last - first), n)
                there = term >= 0
                pair, tf = np.unique(doc[there] * size + term[there], return_counts=True)
                ends = np.searchsorted(pair, np.arange(last - first + 1) * size)
                columns = [batch.column(0).slice(first, last - first), pa.array(n, pa.int64()), lists(pair % size, ends), lists(tf, ends)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(count, "id long, n long, terms array<int>, tfs array<int>"), "search-postings")


class Inverted:
    """The postings of a block of documents by term: documents and what each occurrence count is worth."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, documents: int, length: int):
        m = 75 + (25 * n * documents) // length
        doc = np.repeat(np.arange(len(ids)), sizes)
        worth = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[doc])
        order = np.argsort(terms, kind="stable")
        self.ids, self.doc, self.worth = ids, doc[order], worth[order]
        self.terms, self.first = np.unique(terms[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.most = np.maximum.reduceat(self.worth, self.first) if len(order) else np.zeros(0, np.int64)
        self.sums = np.zeros(len(ids), np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and their scores, that may be among the k best: all that reach ``bar`` and are not surely outdone.

        ``terms`` from the rarest on, with what each is multiplied by.
        """
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        left = np.append(np.cumsum((weights * self.most[at])[::-1])[::-1], 0)  # what the terms from here on can add
        sums, met = self.sums, None
        sums[:] = 0
        for i, (t, weight) in enumerate(zip(at.tolist(), weights.tolist())):
            if met is None and left[i] < bar:
                met = np.flatnonzero(sums)  # no new accumulators
            doc, worth = self.doc[self.first[t] : self.last[t]], self.worth[self.first[t] : self.last[t]]
            if met is None:
                sums[doc] += weight * worth
            elif len(met):
                where = np.minimum(np.searchsorted(doc, met), len(doc) - 1)
                sums[met] += np.where(doc[where] == met, weight * worth[where], 0)
                met = met[sums[met] + left[i + 1] >= bar]
            else:
                break
            begun = sums if met is None else sums[met]
            if len(begun) >= k and left[i + 1] < begun.max():
                bar = max(bar, int(np.partition(begun, len(begun) - k)[len(begun) - k]))
        met = np.flatnonzero(sums) if met is None else met
        met = met[sums[met] >= max(bar, 1)]
        return self.ids[met], sums[met].copy()


def _inverted(batches: Iterator[pa.RecordBatch], documents: int, length: int) -> Iterator[Inverted]:
    for batch in batches:
        ids = batch.column(0).fill_null(_LAST).to_numpy()
        n = batch.column(1).to_numpy()
        terms, tfs = (np.asarray(c.flatten()).astype(np.int64) for c in batch.columns[2:])
        sizes = np.asarray(batch.column(2).value_lengths()).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        a = 0
        while a < len(ids):
            b = min(a + DOCUMENTS, max(a + 1, int(np.searchsorted(ends, ends[a] + POSTINGS, "right")) - 1), len(ids))
            part = slice(int(ends[a]), int(ends[b]))
            if part.start < part.stop:
                yield Inverted(ids[a:b], n[a:b], sizes[a:b], terms[part], tfs[part], documents, length)
            a = b


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _found(index: DataFrame, items: Sequence[tuple[int | None, Mapping[int, int]]], words: int, k: int) -> DataFrame:
    """The k best documents of each item (id, occurrences by term) in every task's part of ``index``, written."""
    spark = index.sparkSession
    of_all = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = of_all["documents"], of_all["length"] or 0
    df = np.zeros(words, np.int64)  # as long as the block's terms
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        df[r["t"]] = r["df"]
    asked = []
    for item_id, own in items:
        terms = np.array(sorted((t for t in own if df[t]), key=lambda t: (df[t], t)), np.int64)
        asked.append((item_id, terms, np.array([own[t] * weight(int(df[t]), documents) for t in terms.tolist()], np.int64)))
    sent = spark.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked)
        for part in _inverted(batches, documents, length):
            for q, (_, terms, weights) in enumerate(asked):
                ids, scores = found[q]
                more, more_scores = part.best(terms, weights, k, int(scores[-1]) if len(scores) == k else 0)
                if len(more):
                    ids, scores = np.concatenate([ids, more]), np.concatenate([scores, more_scores])
                    order = np.lexsort((ids, -scores))[:k]
                    found[q] = ids[order], scores[order]
        sizes = [len(ids) for ids, _ in found]
        if sum(sizes):
            columns = [
                pa.array(np.repeat(np.arange(len(asked)), sizes), pa.int32()),
                pa.array([item_id for (item_id, _, _), size in zip(asked, sizes) for _ in range(size)], pa.int64()),
                pa.array(np.concatenate([ids for ids, _ in found]), pa.int64()),
                pa.array(np.concatenate([scores for _, scores in found]), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc_id", "score"])

    near = index.where("n > 0").mapInArrow(search, _FOUND)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return written(best.select("item_id", "rank", F.nullif("doc_id", F.lit(_LAST)).alias("doc_id"), "score"), "search-found")


@tidied
def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of all ``docs`` for each row of ``items``.

    Terms are runs of digits, letters and all that is not ASCII, A-Z lower-cased, of
    whole texts; null and empty texts have none. A term's weight falls with the number
    of documents that hold it, and what an occurrence adds falls with further ones and
    with the document's length; an item's terms count as often as they occur in it.
    Only documents of a score above 0 are found. Equal scores go by the smaller id, a
    document without id last; rows of ``docs`` that repeat are found each, an item that
    occurs n times has n lists, and items without a term have none. Documents' lengths
    and frequencies cover all rows. Empty tables give an empty result; other columns
    are not looked at.

    Items are taken in blocks of some 4 MB, and all documents are read for each block:
    what goes to all tasks is bounded by that and by the longest item.
    """
    spark = docs.sparkSession
    asked = _item_blocks(items, item_col, item_text_col)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for (part,) in asked.select("part").distinct().orderBy("part").collect():  # an entry for each 4 MB of items
        rows = asked.where((F.col("part.a") == part["a"]) & (F.col("part.b") == part["b"])).select("item_id", "text").collect()
        number: dict[bytes, int] = {}
        block = []
        for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"])):
            own = Counter(terms_of(r["text"]))
            if own:
                block.append((r["item_id"], {number.setdefault(w, len(number)): c for w, c in own.items()}))
        if block:
            index = postings(docs, list(number), id_col, text_col)
            out = out.unionByName(_found(index, block, len(number), k))
    return out
