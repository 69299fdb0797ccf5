"""Hashed character n-grams of whole texts, for a block of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from .common import blocks

_P = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def _lower() -> np.ndarray:
    """The lower-case code point of each below 65,536 that has a single one."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for cp in range(1 << 16):
        if not 0xD800 <= cp < 0xE000 and len(low := chr(cp).lower()) == 1:
            table[cp] = ord(low)
    return table


_LOWER = _lower()


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of UTF-8 bytes, and the offsets in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != len(data):
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        offsets = begins[offsets]
    return np.where(points < 1 << 16, _LOWER[np.minimum(points, 0xFFFF)], points), offsets


def hashed(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket, below 2 ** bits, of the n-gram that begins at each place."""
    if len(points) < n:
        return np.zeros(0, np.int32)
    size = len(points) - n + 1
    code = points[:size] * _P + np.uint32(n)
    for k in range(1, n):
        code ^= code >> np.uint32(15)
        code = code * _P + points[k : k + size]
    code ^= code >> np.uint32(16)
    code *= _MIX
    return (code >> np.uint32(32 - bits)).astype(np.int32)


def grams(texts: pa.Array, lengths: Sequence[int], bits: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each text its place in ``texts`` and, by length, the buckets of all its n-grams in order.

    No n-gram reaches into the next text; a text shorter than n has none.
    """
    for first, last, data, offsets in blocks(texts):
        points, offsets = code_points(data, offsets)
        all_codes = [hashed(points, n, bits) for n in lengths]
        for i in range(last - first):
            a, b = int(offsets[i]), int(offsets[i + 1])
            yield first + i, [codes[a : max(a, b - n + 1)] for codes, n in zip(all_codes, lengths)]
