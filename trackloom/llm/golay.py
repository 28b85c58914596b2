"""The binary Golay code of 23 bits: every word lies within three bits of exactly one of 4096 codewords."""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS = 23
CHECKS = 11
#: The generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def remainder(word: int) -> int:
    for bit in range(BITS - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << bit - CHECKS
    return word


#: Remainder of the upper 12 bits of a word; the lower 11 are their own.
UPPER = np.array([remainder(high << CHECKS) for high in range(1 << BITS - CHECKS)], dtype=np.uint32)
#: The errors behind each remainder: all patterns of at most three bits, one each.
ERRORS = np.zeros(1 << CHECKS, dtype=np.uint32)
for size in range(4):
    for bits in combinations(range(BITS), size):
        pattern = sum(1 << b for b in bits)
        ERRORS[remainder(pattern)] = pattern


def decode(words: np.ndarray) -> np.ndarray:
    """Index of the nearest codeword: its upper 12 bits, which tell codewords apart."""
    words = words.astype(np.uint32)
    wrong = ERRORS[UPPER[words >> np.uint32(CHECKS)] ^ (words & np.uint32((1 << CHECKS) - 1))]
    return (words ^ wrong) >> np.uint32(CHECKS)


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which word, codeword index) of all codewords within four bits of each word: one or six.

    Words that differ in at most one bit share an index: the codeword of the one lies within three bits of it, so within four of the other.
    """
    words = words.astype(np.uint32)
    flips = np.concatenate([np.zeros(1, dtype=np.uint32), np.uint32(1) << np.arange(BITS, dtype=np.uint32)])
    found = np.sort(decode((words[:, None] ^ flips).ravel()).reshape(-1, BITS + 1), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]
