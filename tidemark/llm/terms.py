"""Words of letters and digits, and a bounded list of them known by number, in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from .word_hashes import hashes, lowered, spans

#: A term is a run of digits, letters a-z (A-Z lower-cased) and all that is not ASCII.
_APART = np.ones(256, bool)
_APART[0x30:0x3A] = _APART[0x61:0x7B] = _APART[0x80:] = False


def joined(words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, one after the other, and where each begins and ends."""
    words = list(words)
    return np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text in order."""
    data = lowered(np.frombuffer((text or "").encode(), np.uint8))
    starts, ends, _ = spans(data, np.array([0, len(data)]), _APART)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends)]


class Vocabulary:
    """Numbers of given terms, which are told from all other words by 64 bits."""

    def __init__(self, words: Iterable[bytes]):
        data, offsets = joined(words)
        codes = hashes(data, offsets[:-1], offsets[1:])
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        if (self.codes[1:] == self.codes[:-1]).any():
            raise ValueError("two terms have the same hash")

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's number in the vocabulary, or -1, and for each text its first term's place (one more at the end)."""
        data = lowered(data)
        starts, ends, place = spans(data, offsets, _APART)
        codes = hashes(data, starts, ends)
        if not len(self.codes):
            return np.full(len(codes), -1), place
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.order[at], -1), place


def lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Consecutive parts of ``values`` as lists of int; ``ends`` begins with 0."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
