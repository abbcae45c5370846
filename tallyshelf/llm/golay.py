"""The binary Golay code of length 23, as a fuzzy hash of bit segments.

Every 23-bit word lies within 3 bits of exactly one codeword. The codewords of a
word and of all words one bit away are its keys: one or six. Two words that
differ in two bits or fewer have a word within one bit of both, so they share a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

#: Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11
KEYS = 6


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each word divided by the generator polynomial."""
    rest = words.astype(np.uint32)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where(rest >> np.uint32(bit) & 1, rest ^ np.uint32(GENERATOR << bit - CHECKS), rest)
    return rest


@cache
def errors() -> np.ndarray:
    """The error of at most three bits that each of the 2048 syndromes stands for."""
    patterns = np.array(
        [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(LENGTH), n)],
        np.uint32,
    )
    table = np.zeros(1 << CHECKS, np.uint32)
    table[syndrome(patterns)] = patterns
    return table


@cache
def codeword_indices() -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each of the 2^23 words."""
    words = np.arange(1 << LENGTH, dtype=np.uint32)
    return ((words ^ errors()[syndrome(words)]) >> np.uint32(CHECKS)).astype(np.uint16)


def keys(segments: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each segment of ``bits`` bits, ``(n, 6)``, and which of the six count.

    Bits beyond the segment's own are zero in every word, and no error falls on them.
    """
    words = segments.astype(np.uint32)
    near = np.empty((len(words), bits + 1), np.uint16)
    near[:, 0] = codeword_indices()[words]
    for bit in range(bits):
        near[:, bit + 1] = codeword_indices()[words ^ np.uint32(1 << bit)]
    near.sort(axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    place = np.cumsum(new, axis=1) - 1
    row, column = np.nonzero(new)
    found, counts = np.zeros((len(words), KEYS), np.uint16), np.zeros((len(words), KEYS), bool)
    found[row, place[row, column]] = near[row, column]
    counts[row, place[row, column]] = True
    return found, counts
