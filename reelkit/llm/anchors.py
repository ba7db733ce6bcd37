"""Prefix polynomial hashes of byte strings, and content-chosen anchor positions in them."""

from __future__ import annotations

import numpy as np

#: Fixed value: an odd base, so that its powers can be divided by in arithmetic modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: A seeded random number for each byte value: no run of zero bytes, no small differences.
VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Multipliers that spread a hash's bits.
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX1
    h = (h ^ (h >> np.uint64(33))) * MIX2
    return h ^ (h >> np.uint64(33))


#: Powers that are kept between calls; longer runs are made when asked for and let go.
KEPT = 1 << 18
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _run(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_UP, _DOWN = _run(BASE, KEPT), _run(INVERSE, KEPT)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to 0 .. n and to 0 .. -n, at least."""
    return (_UP, _DOWN) if n <= KEPT else (_run(BASE, n), _run(INVERSE, n))


class Prefixes:
    """Prefix hashes of a buffer: the hash of any substring in constant time.

    hash(i, n) = sum of value[b(i + j)] * BASE^(n - 1 - j), modulo 2^64: made as a difference of two prefix hashes.
    Strings handled here are far shorter than those that collide by their form in this arithmetic; where equal hashes
    decide they are verified on the bytes, or on a digest of them where the bytes lie in different tasks.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        n = len(data)
        self.pow, self.neg = powers(n)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(VALUES[data] * self.neg[:n], dtype=np.uint64, out=self.prefix[1:])

    def hash(self, start, length):
        """Of the substrings from ``start`` (an array), each of ``length`` bytes (a number or an array)."""
        end = start + length
        return (self.prefix[end] - self.prefix[start]) * self.pow[end - 1]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each window of ``width`` values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    # by doubling: the minimum of 2^j values from each position, leftmost first
    best = np.arange(n)
    size = 1
    while 2 * size <= width:
        a, b = best[:len(best) - size], best[size:]
        best = np.where(values[b] < values[a], b, a)
        size *= 2
    count = n - width + 1
    a, b = best[:count], best[width - size:width - size + count]
    return np.where(values[b] < values[a], b, a)
