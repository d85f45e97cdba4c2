"""Words, word shingles and MinHash signatures of one text (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_M = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs of bytes other than space and \\x09-\\x0D, A-Z lower-cased; a null text has none."""
    return [] if text is None else text.lower().split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; with fewer words, of the whole sequence as one; with none, empty."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        out = mix(out + h[i : len(h) - n + 1 + i])
    return out


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the whole text."""
    return np.unique(grams(word_hashes(words(text)), n))


class MinHash:
    """``bands * rows`` multiply-add hash functions on 64 bits; their minima."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def signature(self, s: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 1024):
            np.minimum(low, (self.a[:, None] * s[None, i : i + 1024] + self.b[:, None]).min(1), out=low)
        return (low >> np.uint64(32)).astype(np.uint32)
