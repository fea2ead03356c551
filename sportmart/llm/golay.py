"""The perfect binary Golay code (23 bits, 12 of them information, 3 errors) on numpy arrays."""

from __future__ import annotations

from itertools import combinations

import numpy as np

BITS, INFORMATION, ERRORS = 23, 12, 3
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
GENERATOR = 0b101011100011


def remainder(value: int) -> int:
    """Of the division by the generator, over GF(2)."""
    for bit in range(BITS - 1, 10, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - 11)
    return value


def error_table() -> np.ndarray:
    """The only pattern of up to three errors that leaves a given remainder."""
    table = np.zeros(1 << 11, np.int64)
    for n in range(1, ERRORS + 1):
        for bits in combinations(range(BITS), n):
            pattern = sum(1 << b for b in bits)
            table[remainder(pattern)] = pattern
    return table


TABLE = error_table()
#: Remainders of the upper 12 bits; a remainder is linear and that of the lower 11 bits is themselves.
UPPER = np.array([remainder(v << 11) for v in range(1 << INFORMATION)], np.int64)


def decode(values: np.ndarray) -> np.ndarray:
    """The index, 0 to 4095, of the codeword within three bits of each value."""
    return (values ^ TABLE[UPPER[values >> 11] ^ (values & 0x7FF)]) >> 11


def near_indices(values: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Per value its index and those that one error in the lower ``bits`` bits leads to, sorted, repeats as -1.

    Two values that differ in one of these bits at most have each the other's index among theirs. At most six differ.
    """
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    found = np.sort(decode(values[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
