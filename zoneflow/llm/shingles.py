"""Hashed word shingles of whole texts in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words.

    Words are what stands between ASCII white space, A-Z in lower case. Fewer words than ``size`` make one shingle,
    no words an empty set.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = min(size, len(words))
    out = np.full(len(words) - run + 1, run, np.uint64)
    for k in range(run):
        out ^= out >> np.uint64(31)
        out *= _MULTIPLY
        out += hashed[k : len(words) - run + 1 + k]
    out ^= out >> np.uint64(32)
    out *= _MULTIPLY
    out ^= out >> np.uint64(29)
    return np.unique(out)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, in whole numbers; an empty set is similar to nothing."""
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
