"""BPE encoding and decoding with forced boundaries.

Two adjacent bytes that occur inside no token of the vocabulary can never be joined,
so the text is certainly cut between them. Pieces are cut at all such places, the
fragments are merged one by one, and their ids are put together again.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Recent, lean
from .tokens_base import Vocabulary, chunks, of_chunk, pieces, vocabulary

#: Chunks and fragments whose ids a Python worker remembers at a time, two bytes an id.
CHUNKS, FRAGMENTS = 400_000, 100_000


def inner_pairs(words: Vocabulary) -> list[bytes]:
    """For each byte, by the byte after it, 1 where the two are neighbours inside some token."""
    seen = np.zeros((256, 256), np.uint8)
    for token in words.tokens.values():
        codes = np.frombuffer(token, np.uint8)
        seen[codes[:-1], codes[1:]] = 1
    return [bytes(row) for row in seen]


def fragments(piece: bytes, inner: list[bytes]) -> list[bytes]:
    """``piece`` cut where no token can reach across."""
    cuts = [i + 1 for i in range(len(piece) - 1) if not inner[piece[i]][piece[i + 1]]]
    return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)])]


#: What stands for the rank of a pair that is never joined.
_NONE = 1 << 60
#: Bytes from which on a fragment is merged in rounds.
LONG = 128


def merge(fragment: bytes, words: Vocabulary) -> list[int]:
    """The ids of one fragment: again and again the lowest-rank pair is joined, the leftmost of equal ones first."""
    byte_ids = words.byte_ids
    ids = [byte_ids[b] for b in fragment]
    if len(ids) >= LONG:
        return _in_rounds(ids, words)
    get = words.merges.get
    ranks = [get(a * 65537 + b, _NONE) for a, b in zip(ids, ids[1:])]
    while ranks:
        best = min(ranks)
        if best == _NONE:
            break
        i = ranks.index(best)
        merged = ids[i] = best & 0xFFFF
        del ids[i + 1], ranks[i]
        if i:
            ranks[i - 1] = get(ids[i - 1] * 65537 + merged, _NONE)
        if i < len(ranks):
            ranks[i] = get(merged * 65537 + ids[i + 1], _NONE)
    return ids


def _in_rounds(ids: list[int], words: Vocabulary) -> list[int]:
    """The same for long fragments: in each round the lowest-rank pair is joined wherever it stands, from the left."""
    get = words.merges.get
    while len(ids) > 1:
        best = min(get(a * 65537 + b, _NONE) for a, b in zip(ids, ids[1:]))
        if best == _NONE:
            break
        joined, i, last = [], 0, len(ids) - 1
        while i <= last:
            if i < last and get(ids[i] * 65537 + ids[i + 1]) == best:
                joined.append(best & 0xFFFF)
                i += 2
            else:
                joined.append(ids[i])
                i += 1
        ids = joined
    return ids


class Encoder:
    """Encodes texts, remembering the ids of fragments and of chunks, packed."""

    def __init__(self, words: Vocabulary, remembered: int = CHUNKS):
        self.words, self.inner = words, inner_pairs(words)
        self.fragments = Recent(lambda fragment: array("H", merge(fragment, words)).tobytes(), min(FRAGMENTS, remembered))
        self.chunks = Recent(lambda chunk: self.whole(of_chunk(chunk)), remembered)

    def whole(self, text: str) -> bytes:
        known, inner = self.fragments, self.inner
        return b"".join([known[f] for piece in pieces(text) for f in fragments(piece.encode(), inner)])

    def encode(self, text: str) -> list[int]:
        ids = array("H")
        for part, special in self.words.parts(text):
            if special is not None:
                ids.append(special)
            else:
                first, *rest = chunks(part)
                ids.frombytes(self.whole(first))
                ids.frombytes(b"".join(map(self.chunks.__getitem__, rest)))
        return ids.tolist()


def decode_ids(ids: list[int], words: Vocabulary) -> str:
    """The text of ``ids``; bytes that are no UTF-8 become the replacement character."""
    return b"".join(map(words.decoded.__getitem__, ids)).decode("utf-8", "replace")


def encode(text: Column, path: str) -> Column:
    """The ids (array<int>) of each whole text; those of a null or empty text are an empty array."""

    @F.arrow_udf("array<int>")
    @lean
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        encoder = Encoder(words)
        for batch in batches:
            yield pa.array([encoder.encode(t) if t else [] for t in batch.to_pylist()], pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """The text of each array of ids; null for null. An id that the vocabulary lacks is an error."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        for batch in batches:
            yield pa.array([None if x is None else decode_ids(x, words) for x in batch.to_pylist()], pa.string())

    return text(ids)


def digests(text: Column, path: str, keep_ids: bool = False, remembered: int = CHUNKS) -> Column:
    """A struct (n_tokens, ids_sha256, decoded_sha256) of each text's ids and of the text decoded from them.

    Encodes and decodes in one pass; ``keep_ids`` adds the ids (array<int>). A worker
    remembers the ids of ``remembered`` chunks and as many before them, some 100 bytes each.
    """
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    @F.arrow_udf(fields)
    @lean
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        encoder = Encoder(words, remembered)
        for batch in batches:
            counts, coded, decoded, kept = [], [], [], []
            for t in batch.to_pylist():
                ids = encoder.encode(t or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(words.names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode_ids(ids, words).encode()).hexdigest())
                if keep_ids:
                    kept.append(np.array(ids, np.int32))
            cols = [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.StructArray.from_arrays(cols, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(cols)])

    return both(text)


def with_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, remembered: int = CHUNKS
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``, and its ids if asked; null texts count as empty.

    Equal rows give equal rows, an empty table an empty result; other columns are not
    looked at. A text goes through one Python worker as a whole.
    """
    got = docs.select(F.col(id_col).alias("id"), digests(F.col(text_col), path, keep_ids, remembered).alias("d"))
    return got.select("id", "d.*")
