"""Words of a block of texts as places and 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

#: White space between words, and A-Z lower-cased; all other bytes as they are.
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            one = np.ones(size, np.uint64)
            up, down = one.copy(), one.copy()
            up[1:], down[1:] = np.uint64(_BASE), np.uint64(_INVERSE)
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


def forget() -> None:
    """Free the powers, some 16 bytes for each byte of the longest block; they are made again when asked for."""
    _POWERS.up = _POWERS.down = np.zeros(0, np.uint64)


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _IS_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and for each text its first word's number (one more at the end).

    ``apart`` says of each byte whether it stands between words; white space by default.
    """
    inside = ~apart[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begin[edge] = inside[edge]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    if len(data):
        end[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes and length."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
