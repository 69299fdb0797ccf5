"""Token counts by heap-and-linked-list byte-pair merging; no ids are emitted."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Recent
from .tokens_base import Vocabulary, pieces, vocabulary

#: Pieces whose counts a Python worker remembers at a time.
REMEMBERED = 250_000


def count_merged(piece: bytes, words: Vocabulary) -> int:
    """Tokens of one piece: its bytes less the merges, each time of the lowest-rank adjacent pair, the leftmost first.

    The pairs wait in a heap, the symbols are a doubly linked list; an entry whose
    symbols have changed meanwhile is stale and skipped.
    """
    symbols = [words.byte_ids[b] for b in piece]
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    merges = words.merges
    heap = []
    for i in range(n - 1):
        if (found := merges.get(symbols[i] * 65537 + symbols[i + 1])) is not None:
            heap.append((found, i, symbols[i], symbols[i + 1]))
    heapify(heap)
    left = n
    while heap:
        found, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        merged = symbols[i] = found & 0xFFFF
        symbols[j] = -1
        after[i] = k = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if (found := merges.get(merged * 65537 + symbols[k])) is not None:
                heappush(heap, (found, i, merged, symbols[k]))
        if (h := before[i]) >= 0 and (found := merges.get(symbols[h] * 65537 + merged)) is not None:
            heappush(heap, (found, h, symbols[h], merged))
    return left


class Counter:
    """Counts texts' tokens, remembering the counts of pieces."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.pieces = Recent(lambda piece: count_merged(piece.encode(), words), REMEMBERED)

    def count(self, text: str) -> int:
        known = self.pieces.__getitem__
        return sum(1 if special is not None else sum(map(known, pieces(part))) for part, special in self.words.parts(text))


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of each whole text (long), special strings counting as one; null is empty and has 0."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(vocabulary(path))
        for batch in batches:
            yield pa.array([counter.count(t) if t else 0 for t in batch.to_pylist()], pa.int64())

    return count(text)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of ``docs``, in any number of equal rows.

    A null text counts as empty; an empty table gives an empty result; other columns
    are not looked at. A text goes through one Python worker as a whole, whose memory
    grows with its longest text.
    """
    count = n_tokens(F.col("text"), path)
    return (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .select("id", F.octet_length("text").cast("long").alias("n_bytes"), count.alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
