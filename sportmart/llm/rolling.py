"""Words of many texts and rolling hashes over them, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes that are cut into words at a time.
BLOCK = 1 << 18
#: Longer words are hashed one by one.
LONG_WORD = 1 << 16
BASE = 0x9E3779B97F4A7C15
STEP = 0xD1342543DE82EF95

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII other than letters and digits.
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a hash so that all its bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def at_least(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << (n - 1).bit_length()
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[s:e]`` as polynomials, whatever their place (Karp and Rabin)."""
        self.at_least(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


_BYTES, _WORDS = Powers(BASE), Powers(STEP)


@dataclass
class Block:
    """Words of some texts: their bytes in ``raw``, hashes, and the text each belongs to."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every ``n`` words in a row, and whether all are of one text."""
        count = max(0, len(self.hashes) - n + 1)
        first = np.arange(count)
        return _WORDS.spans(self.hashes, first, first + n), self.texts[:count] == self.texts[n - 1 :][:count]

    def joined(self, first: int, n: int) -> str:
        """``n`` words from the word ``first`` on, joined by a blank."""
        words = (self.raw[s:e] for s, e in zip(self.starts[first : first + n], self.ends[first : first + n]))
        return b" ".join(words).decode("utf-8", "replace")


def cut(raw: bytes, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a short ``raw``."""
    values = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(values) + 2, np.int8)
    inside[1:-1] = ~apart[values]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return starts, ends, _BYTES.spans(values.astype(np.uint64) + np.uint64(1), starts, ends)


def long_word_pattern(apart: np.ndarray) -> re.Pattern:
    kind = "".join(re.escape(chr(b)) for b in np.flatnonzero(apart))
    return re.compile(f"[^{kind}]{{{LONG_WORD},}}".encode("latin-1"))


def cut_long(raw: bytes, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for a long text, in parts that end between words; overlong words are hashed apart."""
    import xxhash

    found: list[tuple] = []

    def plain(at: int, end: int) -> None:
        while at < end:
            stop = min(at + BLOCK, end)
            while stop < end and not apart[raw[stop]]:
                stop += 1
            starts, ends, hashes = cut(raw[at:stop], apart)
            found.append((starts + at, ends + at, hashes))
            at = stop

    at = 0
    for long in long_word_pattern(apart).finditer(raw):
        plain(at, long.start())
        digest = xxhash.xxh64_intdigest(long[0], 0)
        found.append((np.array([long.start()]), np.array([long.end()]), np.array([digest], np.uint64)))
        at = long.end()
    plain(at, len(raw))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def blocks(texts: list[bytes], apart: np.ndarray, lower: bool = False) -> Iterator[Block]:
    """Texts as blocks of about ``BLOCK`` bytes; a text stays whole. Empty texts occur in no block."""

    def prepared(raw: bytes) -> bytes:
        return LOWER[np.frombuffer(raw, np.uint8)].tobytes() if lower else raw

    held: list[int] = []
    size = 0
    for i in range(len(texts) + 1):
        last = i == len(texts)
        if held and (last or size >= BLOCK or len(texts[i]) >= LONG_WORD):
            raw = prepared(b" ".join(texts[k] for k in held))
            starts, ends, hashes = cut(raw, apart)
            borders = np.cumsum([len(texts[k]) + 1 for k in held])
            yield Block(raw, starts, ends, hashes, np.array(held)[np.searchsorted(borders, starts, side="right")])
            held, size = [], 0
        if last:
            return
        if len(texts[i]) >= LONG_WORD:
            raw = prepared(texts[i])
            starts, ends, hashes = cut_long(raw, apart)
            yield Block(raw, starts, ends, hashes, np.full(len(starts), i))
        elif texts[i]:
            held.append(i)
            size += len(texts[i]) + 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values in a row, by doubling."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:]) if len(least) > span else least[:0]
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest and len(least) > rest else least[: max(0, len(least) - rest)]
