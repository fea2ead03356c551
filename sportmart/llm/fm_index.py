"""A compressed full-text index of a sequence of numbers: Burrows-Wheeler transform in a wavelet matrix.

The index answers backward search for many patterns at once. Suffixes are sorted by prefix doubling as deep as the patterns
are long; for patterns of up to that length the intervals are those of a full sort.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: packed words and the ones before each of them."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int((~ones).sum())))
            values = np.concatenate([values[~ones], values[ones]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbol's occurrences before ``at`` end among its own in the last level."""
        for bit, ones, zeros in self.levels:
            before = ones.rank(at)
            at = np.where(symbol >> bit & 1, zeros + before, at - before)
        return at


class FmIndex:
    """Index of ``sequence``: symbols from 1 on, with 0 behind every text."""

    def __init__(self, sequence: np.ndarray, depth: int):
        """``depth``: length of the longest pattern, and of the classes of suffixes that begin alike."""
        n = len(sequence)
        self.depth = depth
        symbols = int(sequence.max()) + 1
        # Prefix doubling: ranks by the first 1, 2, 4 ... symbols.
        rank = sequence.astype(np.int64)
        span, order, inner = 1, np.argsort(rank, kind="stable"), rank
        while span <= depth:
            if span * 2 > depth >= span:
                inner, inner_span = rank, span
            later = np.zeros(n, np.int64)
            later[: n - span] = rank[span:] + 1 if n > span else 0
            key = rank * (n + symbols + 2) + later
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            span *= 2
        self.suffixes = order
        # Suffixes with the same first ``depth`` symbols: two overlapping spans of a power of two agree.
        padded = np.concatenate([inner, np.full(depth, -1)])
        tail = padded[order + depth - inner_span]
        head = inner[order]
        fresh = np.concatenate([[True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])
        self.class_of = np.cumsum(fresh) - 1
        self.class_starts = np.append(np.flatnonzero(fresh), n)
        before = sequence[order - 1].astype(np.int64)
        self.wavelet = WaveletMatrix(before, symbols)
        counts = np.bincount(sequence, minlength=symbols)
        smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        every = np.arange(symbols)
        self.base = smaller - self.wavelet.place(every, np.zeros(symbols, np.int64))
        self.size = n

    def extended(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of ``symbol`` followed by what ``low`` and ``high`` stand for; empty for unknown symbols."""
        known = np.minimum(symbol, len(self.base) - 1)
        twice = np.tile(known, 2)
        both = self.base[twice] + self.wavelet.place(twice, np.concatenate([low, high]))
        low, high = both[: len(low)], both[len(low) :]
        return low, np.where(symbol < len(self.base), high, low)

    def intervals(self, sequence: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns ``sequence[a : a + n]``."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.size, np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((sizes > step) & (low < high))
            low[live], high[live] = self.extended(low[live], high[live], sequence[at[live] + sizes[live] - 1 - step])
        return low, high

    def longest(self, sequence: np.ndarray, at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest match that starts at each place, ``most`` at most, by halving."""
        least, most = np.zeros(len(at), np.int64), most.astype(np.int64)
        while (least < most).any():
            middle = (least + most + 1) // 2
            low, high = self.intervals(sequence, at, middle)
            least, most = np.where(low < high, middle, least), np.where(low < high, most, middle - 1)
        return least

    def shortened(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the first ``depth`` symbols of the suffix at ``low``."""
        at = self.class_of[low]
        return self.class_starts[at], self.class_starts[at + 1]

    def matching_statistics(self, sequence: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For texts ``sequence[s:e]``, streamed backwards side by side: per place the length of the longest match that
        starts there, ``depth`` at most, and the interval of the match where that length is reached (else an empty one).

        Where a match cannot be extended, its longest part that can is looked for; one longer than ``depth`` loses its
        last symbol. Patterns never hold a 0, so matches never reach over the end of an indexed text.
        """
        length = np.zeros(len(sequence), np.int32)
        low, high = np.zeros(len(sequence), np.int64), np.zeros(len(sequence), np.int64)
        order = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[order], ends[order]
        sizes = ends - starts
        a, b = np.zeros(len(starts), np.int64), np.full(len(starts), self.size, np.int64)
        n = np.zeros(len(starts), np.int32)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -step, side="left"))  # texts longer than the step come first
            at = ends[:live] - 1 - step
            c = sequence[at].astype(np.int64)
            low_a, high_b = self.extended(a[:live], b[:live], c)
            n[:live] += 1
            lost = np.flatnonzero(low_a >= high_b)
            if len(lost):
                n[lost] = self.longest(sequence, at[lost], n[lost] - 1)
                low_a[lost], high_b[lost] = self.intervals(sequence, at[lost], n[lost])
            full = n[:live] >= self.depth
            if full.any():
                low_a[full], high_b[full] = self.shortened(low_a[full])
                n[:live][full] = self.depth
                low[at[full]], high[at[full]] = low_a[full], high_b[full]
            a[:live], b[:live] = low_a, high_b
            length[at] = n[:live]
        return length, low, high
