"""Word hashes and shingle sets of texts, made inside tasks."""

from __future__ import annotations

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

# Workers get the code of this module with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
CACHE = 200_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hashes of words; one that is asked for again is looked up. Emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words, in order of the runs; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total = total * _STEP + hashes[k : k + n]
    return mix(total)


def shingle_set(text: bytes, cache: WordHashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = cache.of(words)
    if len(words) < size:
        return window_hashes(hashes, len(words)) + np.uint64(len(words))
    return np.unique(window_hashes(hashes, size))
