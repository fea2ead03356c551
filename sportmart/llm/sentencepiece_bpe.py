"""SentencePiece BPE in numpy: texts to ids and back, as the library does with the same model.

All words of a block of texts that are not cached are merged together. Their symbols lie in one flat array; each
round finds every word's smallest pair rank, merges its leftmost pairs of that rank in all words at once
and compacts the array, until no word has a pair left.

Rounds are as many as a word's merges at worst, so long words are cut first. A place that lies inside no piece of the text
divides a word for good. What is still long is read in windows that overlap; each is merged as a word of its own, and they are joined at a
piece that both have. That is exact: pieces are the merging of their text if every two neighbours are
that of theirs, since the first merge across a border would also be made in the text of the two alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
NONE = np.int64(2**31 - 1)
#: Characters of text that are encoded at a time, ids in a worker's cache of words before it is emptied.
BLOCK = 1 << 18
CACHE_IDS = 1_500_000
#: Symbols of a word that is cut before it is merged; symbols from one window to the next, and how many steps long a window is.
LONG = 128
STEP = 32
STEPS = 2
#: Windows that are merged at a time.
WINDOWS = 2048
#: Texts whose ids and decoded texts are held at a time.
ROWS = 500


class Vocabulary:
    """Pieces, ranks and pair table of a model without normalisation rules."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.eos = model.eos_id()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        control = [model.is_control(i) or model.is_unknown(i) for i in range(self.size)]
        byte = [model.is_byte(i) for i in range(self.size)]
        normal = {p: i for i, p in enumerate(pieces) if not (control[i] or byte[i] or model.is_unused(i))}
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(pieces):
            if byte[i]:
                self.byte_ids[int(p[1:-1], 16)] = i
        scores = np.array([model.get_score(i) for i in range(self.size)], np.float64)
        # The best score has rank 0; equal scores share a rank and the leftmost pair goes first.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # Characters by code point: the id of their piece, or minus one.
        single = {ord(p): i for p, i in normal.items() if len(p) == 1}
        self.char_ids = np.full(0x110000, -1, np.int32)
        self.char_ids[list(single)] = list(single.values())
        joined = set("".join(p for p in normal if len(p) > 1)) - {SPACE}
        inside = any(SPACE in p.lstrip(SPACE) for p in normal)
        if inside or any(len(p) > 1 and c not in normal for p in normal for c in p):
            raise ValueError("pieces across words, or of characters that are no pieces, are not supported")
        # Pieces of each length by the hash of their characters, to find all that a text holds.
        self.piece_hashes = {
            n: np.unique(char_hashes(np.array([[ord(c) for c in p] for p in normal if len(p) == n], np.uint64), n).ravel())
            for n in sorted({len(p) for p in normal if len(p) > 1})
        }
        self.symbols = np.ones(self.size, np.int64)
        self.symbols[list(normal.values())] = [len(p) for p in normal]
        # No piece reaches over a blank's start or a character that occurs in no longer piece, so words end there.
        letters = "".join(map(re.escape, sorted(joined)))
        self.words = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]+")
        # Surfaces of ids, as bytes, for decoding.
        surface = [
            b"" if control[i] else bytes([int(p[1:-1], 16)]) if byte[i] else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.is_byte = np.array(byte)
        self.blob = np.frombuffer(b"".join(surface), np.uint8)
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that two neighbours make, or minus one."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        made = self.pair(left, right)
        return np.where(made >= 0, self.rank[made], NONE)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's ids end."""
        short = [w for w in words if len(w) <= LONG]
        ids, ends = self.merged_words(*self.symbols_of(short)) if short else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if len(short) < len(words):
            at, parts = 0, []
            starts = np.concatenate([[0], ends])
            for w in words:
                if len(w) <= LONG:
                    parts.append(ids[starts[at] : starts[at + 1]])
                    at += 1
                else:
                    parts.append(self.long_word(w))
            ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        word = np.repeat(np.arange(len(words)), np.diff(np.concatenate([[0], ends])))
        return self.with_bytes(ids, word, len(words))

    def symbols_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words, and how many each has."""
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbol = self.char_ids[code].astype(np.int64)
        symbol[symbol < 0] = -1 - code[symbol < 0]  # characters without a piece stay recognisable
        return symbol, np.array([len(w) for w in words], np.int64)

    def merged_words(self, symbol: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of words that lie one behind the other, and where each word's end."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        done_symbol, done_word = [], []
        while len(symbol):
            symbol, word, ended, ended_word = self.merge_round(symbol, word)
            done_symbol.append(ended)
            done_word.append(ended_word)
        symbol = np.concatenate(done_symbol) if done_symbol else symbol
        word = np.concatenate(done_word) if done_word else word
        return symbol[np.argsort(word, kind="stable")], np.cumsum(np.bincount(word, minlength=len(sizes)))

    def long_word(self, text: str) -> np.ndarray:
        """Merged symbols of one long word, cut where no piece reaches over."""
        symbol, _ = self.symbols_of([text])
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        depth = np.zeros(len(code) + 1, np.int64)
        for n, known in self.piece_hashes.items():
            if n > len(code):
                break
            hashes = char_hashes(np.lib.stride_tricks.sliding_window_view(code, n), n)
            near = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            held = np.flatnonzero(known[near] == hashes)
            # Borders inside the piece: behind its first character to before its last.
            np.add.at(depth, held + 1, 1)
            np.add.at(depth, held + n, -1)
        cuts = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
        cuts = np.append(cuts[cuts > 0], len(code))
        sizes = np.diff(np.concatenate([[0], cuts]))
        long = sizes > LONG
        few = np.repeat(~long, sizes)
        ids, ends = self.merged_words(symbol[few], sizes[~long]) if few.any() else (symbol[:0], np.zeros(0, np.int64))
        if not long.any():
            return ids
        parts, at, done = [], 0, 0
        starts = np.concatenate([[0], ends])
        for start, size, wide in zip(cuts - sizes, sizes, long):
            if wide:
                parts += [ids[starts[done] : starts[at]], self.windowed(symbol[start : start + size])]
                done = at
            else:
                at += 1
        return np.concatenate([*parts, ids[starts[done] :]])

    def windowed(self, symbol: np.ndarray, least: int = STEP) -> np.ndarray:
        """Merged symbols of a long stretch, joined from windows; where two have no piece in common, the rest is read in windows twice
        as long."""
        step = self.stride(symbol, least)
        starts = np.arange(0, max(1, len(symbol) - step), step)
        out, path, begins = [], None, None
        for first in range(0, len(starts), WINDOWS):
            some = starts[first : first + WINDOWS]
            ends = np.minimum(some + STEPS * step, len(symbol))
            ids, stops = self.merged_words(gather(symbol, some, ends - some), ends - some)
            for start, a, b in zip(some.tolist(), np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist()):
                own = ids[a:b]
                places = start + np.cumsum(self.widths(own)) - self.widths(own)
                if path is None:
                    path, begins = own, places
                    continue
                # The first piece that both have at the same place.
                at = np.searchsorted(begins, places)
                same = (at < len(begins)) & (begins[np.minimum(at, len(begins) - 1)] == places)
                same &= path[np.minimum(at, len(path) - 1)] == own
                if not same.any():
                    rest = self.windowed(symbol[begins[0] :], 2 * least)
                    # It goes on from what is there if it begins with the same piece; else all is read anew.
                    return np.concatenate([*out, rest]) if rest[0] == path[0] else self.windowed(symbol, 2 * least)
                k = int(np.flatnonzero(same)[0])
                out.append(path[: at[k]])
                path, begins = own[k:], places[k:]
        return np.concatenate([*out, path])

    def widths(self, symbol: np.ndarray) -> np.ndarray:
        """Characters of each merged symbol."""
        return np.where(symbol >= 0, self.symbols[np.maximum(symbol, 0)], 1)

    def stride(self, symbol: np.ndarray, least: int) -> int:
        """Symbols from one window to the next. In text that repeats itself windows share pieces if they begin at like places, so it is
        a border of the first window's pieces behind which the text goes on as it began, if there is one."""
        head = symbol[: 3 * least]
        borders = np.cumsum(self.widths(self.merged_words(head, np.array([len(head)]))[0]))
        for border in borders[(borders >= least // 2) & (borders <= 2 * least)].tolist():
            if np.array_equal(symbol[border : border + least], symbol[:least]):
                return border
        return least

    def merge_round(self, symbol: np.ndarray, word: np.ndarray):
        """One round; words that have no pair left come back apart."""
        n = len(symbol)
        made = np.full(n, -1, np.int64)
        same = word[:-1] == word[1:]
        made[:-1][same] = self.pair(symbol[:-1][same], symbol[1:][same])
        rank = np.where(made >= 0, self.rank[made], NONE)
        start = np.flatnonzero(np.concatenate([[True], ~same])) if n > 1 else np.zeros(1, np.int64)
        size = np.diff(np.append(start, n))
        least = np.minimum.reduceat(rank, start)
        best = np.repeat(least, size)
        live = best < NONE
        if not live.any():
            return symbol[:0], word[:0], symbol, word
        ended, ended_word = symbol[~live], word[~live]
        symbol, word, made, rank, best = symbol[live], word[live], made[live], rank[live], best[live]
        # Of pairs that overlap, the leftmost goes first: every other one of a run.
        hit = np.flatnonzero(rank == best)
        fresh = np.concatenate([[True], (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]])])
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        hit = hit[self.in_turn(symbol, word, made, best, hit)]
        symbol[hit] = made[hit]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        return symbol[keep], word[keep], ended, ended_word

    def in_turn(self, symbol, word, made, best, hit) -> np.ndarray:
        """Which merges may be done together. One merge after the other, a new pair could outrank those still waiting;
        in a word where that is possible only the leftmost merge is done."""
        n, limit, new = len(symbol), best[hit], made[hit]
        first = np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])
        after = np.minimum(hit + 2, n - 1)
        right_rank = np.where(
            (hit + 2 < n) & (word[after] == word[hit]), self.pair_rank(new, symbol[after]), NONE
        )
        touching = ~first & np.concatenate([[False], np.diff(hit) == 2])
        before = np.where(touching, np.concatenate([[0], new[:-1]]), symbol[np.maximum(hit - 1, 0)])
        has_left = (hit > 0) & (word[np.maximum(hit - 1, 0)] == word[hit])
        left_rank = np.where(has_left, self.pair_rank(before, new), NONE)
        risky = (right_rank <= limit) | (left_rank <= limit)
        group = np.flatnonzero(first)
        risky_word = np.repeat(np.logical_or.reduceat(risky, group), np.diff(np.append(group, len(hit))))
        return first | ~risky_word

    def with_bytes(self, symbol: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their bytes."""
        if (symbol < 0).any():
            parts, times = [], np.ones(len(symbol), np.int64)
            other = np.flatnonzero(symbol < 0)
            for at in other.tolist():
                raw = np.frombuffer(chr(-1 - int(symbol[at])).encode("utf-8", "replace"), np.uint8)
                parts.append(self.byte_ids[raw])
                times[at] = len(raw)
            was_other = np.repeat(symbol < 0, times)
            ids = np.repeat(symbol, times)
            ids[was_other] = np.concatenate(parts)
            symbol, word = ids, np.repeat(word, times)
        return symbol.astype(np.int32), np.cumsum(np.bincount(word, minlength=n_words))

    def decode(self, ids: np.ndarray) -> str:
        """The library's text for ``ids``: bytes joined, one leading blank taken off, control ids silent."""
        ids = np.asarray(ids, np.int64)
        ids = ids[self.lengths[ids] > 0]
        if not len(ids):
            return ""
        raw = gather(self.blob, self.starts[ids], self.lengths[ids]).tobytes()
        if not self.is_byte[ids[0]] and raw.startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return one_by_one(raw)


def char_hashes(windows: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of rows of ``n`` code points; a collision only makes a cut fewer."""
    value = np.zeros(windows.shape[:-1], np.uint64)
    for k in range(n):
        value = value * np.uint64(0x9E3779B97F4A7C15) + windows[..., k] + np.uint64(1)
    return value


def one_by_one(raw: bytes) -> str:
    """UTF-8 with a replacement character for every byte that starts no character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``values[s : s + n]``."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return values[shift + np.arange(total)]


class Encoder:
    """Encodes texts through a cache of words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > CACHE_IDS:
            self.forget()
        new = [w for w in words if w not in self.index]
        if not new:
            return
        ids, ends = self.vocabulary.encode_words(new)
        lengths = np.diff(np.concatenate([[0], ends]))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.ids) + ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])

    def block(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words`` one behind the other, and how many each has."""
        distinct = set(words)
        self.learn(distinct)
        if not distinct <= self.index.keys():  # emptied meanwhile
            self.learn(distinct)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        return gather(self.ids, self.starts[at], self.lengths[at]), self.lengths[at]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the end id. An empty text has the end id alone."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        spans: list[tuple[int, int]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if words:
                ids, lengths = self.block(words)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                at = 0
                for i, n in spans:
                    out[i].append(ids[ends[at] : ends[at + n]])
                    at += n
            words.clear()
            spans.clear()
            held = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            spaced = SPACE + text.replace(" ", SPACE)
            at = 0
            while at < len(spaced):
                end = word_break(spaced, at + BLOCK)
                found = self.vocabulary.words.findall(spaced, at, end)
                words += found
                spans.append((i, len(found)))
                held += end - at
                at = end
                if held >= BLOCK:
                    flush()
        flush()
        eos = np.array([self.vocabulary.eos], np.int32)
        return [np.concatenate([*parts, eos]) for parts in out]


def word_break(spaced: str, at: int) -> int:
    """The first place from ``at`` on where a word ends for sure: before a blank behind none."""
    while 0 < at < len(spaced):
        at = spaced.find(SPACE, at)
        if at < 0:
            break
        if spaced[at - 1] != SPACE:
            return at
        at += 1
    return len(spaced)


_WORKER: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process and model; its cache outlives the task."""
    if path not in _WORKER:
        _WORKER.clear()
        _WORKER[path] = Encoder(path)
    return _WORKER[path]


def round_trip(path: str):
    """A column function ``text -> struct<ids: array<int>, text: string>`` for the model at ``path``: ids with the
    end id, and their decoded text. Null counts as empty: the end id alone, an empty text."""

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(path)
        parts = (batch.slice(at, ROWS) for batch in batches for at in range(0, len(batch), ROWS))
        for part in parts:
            ids = encoder.encode([t or "" for t in part.to_pylist()])
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            )
            texts = pa.array([encoder.vocabulary.decode(x) for x in ids], pa.string())
            yield pa.StructArray.from_arrays([lists, texts], ["ids", "text"])

    return coded


def digests(coded: Column) -> list[Column]:
    ids, text = coded["ids"], coded["text"]
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(text, 256).alias("decoded_sha256"),
    ]
