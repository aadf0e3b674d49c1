"""The binary Golay code of length 23: nearby codewords of a word, by table.

The code is perfect with distance 7, so every 23-bit word is within 3 bits of exactly one
codeword. A word at distance 3 has five more codewords at distance 4, any other word has none. Two
words that differ in at most two bits have a codeword within 4 bits of both: the one nearest to a
word half way between them.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, DATA_BITS = 23, 12
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the code.
GENERATOR = 0b110001110101
NEARBY = 6


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders modulo the generator."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, LENGTH - DATA_BITS - 1, -1):
        rest = np.where((rest >> bit) & 1, rest ^ (GENERATOR << (bit - (LENGTH - DATA_BITS))), rest)
    return rest


@lru_cache(maxsize=1)
def nearby_errors() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome: up to six error patterns of weight 4 or less, the lightest first, and how many there are."""
    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(LENGTH), w)], np.int64)
    table = np.zeros((1 << (LENGTH - DATA_BITS), NEARBY), np.int64)
    count = np.zeros(len(table), np.int64)
    for pattern, s in zip(patterns.tolist(), syndromes(patterns).tolist(), strict=True):
        table[s, count[s]] = pattern
        count[s] += 1
    return table, count


@lru_cache(maxsize=1)
def _halves() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits; a word's syndrome is their sum, so no table of all words is needed."""
    return syndromes(np.arange(1 << 12)), syndromes(np.arange(1 << (LENGTH - 12)) << 12)


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) 12-bit indices of the codewords within 4 bits of each 23-bit word, and how many hold (1 or 6)."""
    table, count = nearby_errors()
    low, high = _halves()
    s = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ table[s]) >> (LENGTH - DATA_BITS), count[s]
