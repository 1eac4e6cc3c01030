"""Names of substrings by bucket pointers: the name of a long string is made of the names of its halves.

A string of 8 bytes is its own name (mixed, one to one).  The bucket of a string of 2h bytes at offset i is
named by the pair of the buckets of h bytes at i and at the later offset i + h, and a string of any length by
the two strings of the greatest power of two that begin and end it.  Pairs go through a mixer that is not
linear, so there is no family of strings with equal names, as sums of powers have.
"""

from __future__ import annotations

import numpy as np

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair of names."""
    x = a * A
    x += b * B
    return mixed(x)


class Names:
    """Names of the substrings of ``data`` of 8 bytes or more; those of up to ``top`` bytes (a power of two) are
    kept for every offset, longer ones are refined from them where they are asked for."""

    def __init__(self, data: np.ndarray, top: int = 32):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ascontiguousarray(np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[: len(data)])
        self.kept = {8: mixed(eight)}
        h = 8
        while 2 * h <= top:
            own = self.kept[h]
            self.kept[2 * h] = paired(own[:-h], own[h:]) if len(own) > h else own[:0]
            h *= 2

    def bucket(self, length: int, at: np.ndarray) -> np.ndarray:
        """The names of ``length`` bytes (a power of two) from each of the places ``at``."""
        if length in self.kept:
            return self.kept[length][at]
        return paired(self.bucket(length // 2, at), self.bucket(length // 2, at + length // 2))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The names of the bytes from begin to end, 8 or more, for arrays of places."""
        size = end - begin
        out = np.zeros(len(size), np.uint64)
        power = np.frexp(size.astype(np.float64))[1] - 1
        for p in np.unique(power).tolist():
            own = np.flatnonzero(power == p)
            a, b = begin[own], end[own]
            out[own] = paired(paired(self.bucket(1 << p, a), self.bucket(1 << p, b - (1 << p))), size[own].astype(np.uint64))
        return out

    def grams(self, k: int) -> np.ndarray:
        """The names of all substrings of ``k`` bytes."""
        n = len(self.kept[8]) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        at = np.arange(n)
        return self.kept[k][:n] if k in self.kept else self.of(at, at + k)
