"""64-bit hashes of words and of runs of consecutive words, computed in arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers for two independent run hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Words kept in a task's table before it starts afresh.
KEPT_WORDS = 200_000


class WordHashes(dict):
    """Word (bytes) to its hash; remembers words up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word (splitmix finalizer)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def run_hashes(words: np.ndarray, k: int, base: int = BASES[0], starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``words[i : i + k]`` for every ``i``, or for ``starts`` only."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    b = np.uint64(base)
    if starts is None:
        h = words[:n].copy()
        for j in range(1, k):
            h *= b
            h += words[j : n + j]
    else:
        h = words[starts]
        for j in range(1, k):
            h *= b
            h += words[starts + j]
    return mixed(h)
