"""Sets of hashed word shingles, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import blocks
from .word_hashes import hashes, lowered, mix, spans

#: Words in a shingle.
WORDS = 5
_STEP = np.uint64(0xFF51AFD7ED558CCD)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each whole text the sorted distinct hashes of its 5-word shingles.

    A text of one to four words has its word sequence as its only shingle, one
    without words has none. A-Z count as a-z. Shingles are told apart by 64 bits.
    """
    for first, last, data, offsets in blocks(texts):
        data = lowered(data)
        starts, ends, number = spans(data, offsets)
        codes = hashes(data, starts, ends)
        size = max(0, len(codes) - WORDS + 1)
        rolled = np.zeros(size, np.uint64)
        for k in range(WORDS):
            rolled = rolled * _STEP + codes[k : k + size]
        rolled = mix(rolled)
        for i in range(last - first):
            a, b = int(number[i]), int(number[i + 1])
            if b - a >= WORDS:
                yield np.unique(rolled[a : b - WORDS + 1])
            elif b > a:
                few = np.array([b - a], np.uint64)
                for k in range(a, b):
                    few = few * _STEP + codes[k : k + 1]
                yield mix(few)
            else:
                yield rolled[:0]
