"""Sets of hashed word shingles of many texts at once (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2127599BF4325C37, 0x880355F21E6D1965], dtype=np.uint64)


class _WordHashes(dict):
    """word -> 64-bit hash, remembered while the memory bound allows."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD[0]
    x = x ^ (x >> np.uint64(29))
    x = x * _ODD[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text,
    A-Z lower-cased; a text of fewer words is one shingle, one without words none."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    if n < width:
        one = np.array([n], np.uint64)
        for i in range(n):
            one = mix(one * _ODD[2] + h[i:i + 1])
        return one
    acc = mix(h[: n - width + 1] + _ODD[3])
    for i in range(1, width):
        acc = mix(acc * _ODD[4] + h[i: n - width + 1 + i])
    acc.sort()
    keep = np.empty(len(acc), bool)
    keep[0] = True
    np.not_equal(acc[1:], acc[:-1], out=keep[1:])
    return acc[keep]
