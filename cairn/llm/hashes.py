"""64-bit hashes of words and of what is made of them."""

from __future__ import annotations

import numpy as np
import xxhash

# Words that are remembered.
WORD_MEMORY = 1 << 18
MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * SPREAD
    return h ^ (h >> np.uint64(29))


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h
