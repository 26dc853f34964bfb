"""Hashed word shingles of whole texts (numpy, one text at a time)."""

from __future__ import annotations

import numpy as np

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # A-Z alone
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least ``n`` of each."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _ODD))])
        _INVERSES = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, inverse))])
    return _POWERS, _INVERSES


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: runs other than space and \\x09-\\x0D, A-Z in lower case."""
    data = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    return mix(value + (end - start).astype(np.uint64) * _ODD)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles.

    A text with fewer words has its whole sequence as one shingle; one without
    words, or null, has none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text)
    if len(words) == 0:
        return words
    take = min(width, len(words))
    count = len(words) - take + 1
    out = np.full(count, np.uint64(take))
    for k in range(take):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k:k + count]
    return np.unique(mix(out))
