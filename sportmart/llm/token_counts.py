"""Token counts of texts under a byte-level BPE vocabulary, by looking pre-tokens up instead of merging them.

Two tiers answer a pre-token on the map side: a compact broadcast table of frequent pre-tokens, and a cache in each Python
worker for the rest, filled by the tokenizer itself. No pre-token is shuffled. The table and the cache
only save work: what they hold is what the tokenizer says.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm.common import importable

#: Stretches of texts that the table of frequent pre-tokens is drawn from, about so many, and the longest of them in characters: at
#: most 16 million characters reach the driver. The table has so many entries of MAX_KEY characters at most.
SAMPLE_TEXTS = 2000
SAMPLE_CHARS = 8192
TABLE_ENTRIES = 65_536
#: Entries of a worker's cache before it is emptied, and the longest pre-token it keeps.
CACHE_ENTRIES = 300_000
MAX_KEY = 64
#: Characters that are split into pre-tokens at a time.
PIECE = 1 << 20
#: Up to here every Unicode version agrees about letters, digits and spaces.
SETTLED = re.compile("[^\x00-՗]")
BREAK = re.compile(r"(?<=[!-~]) (?=[!-~])")


class Lengths(dict):
    """Pre-token to number of tokens: frequent entries that stay, others that are asked for once and go when many."""

    def __init__(self, frequent: dict[str, int], tokenizer):
        super().__init__(frequent)
        self.frequent, self.tokenizer = frequent, tokenizer

    def __missing__(self, pre_token: str) -> int:
        n = len(self.tokenizer.encode(pre_token, add_special_tokens=False).ids)
        if len(pre_token) <= MAX_KEY:
            if len(self) >= len(self.frequent) + CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[pre_token] = n
        return n


class TokenCounter:
    """Counts of one worker for one vocabulary file."""

    def __init__(self, path: str, pattern: str, frequent: dict[str, int]):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))))
        self.lengths = Lengths(frequent, self.tokenizer)
        self.agreed: dict[str, bool] = {}

    def agrees(self, text: str) -> bool:
        """Whether pattern and tokenizer class every character alike; their Unicode versions may differ."""
        if text.isascii() or not SETTLED.search(text):
            return True
        for c in set(text):
            if c > "՗" and c not in self.agreed:
                probe = f"a{c}1{c} {c}!{c}a"
                own = [probe[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)]
                self.agreed[c] = own == self.pattern.findall(probe)
        return all(self.agreed.get(c, True) for c in set(text))

    def count(self, text: str) -> int:
        if not self.agrees(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if not any(s in text for s in self.specials):
            return self.plain(text)
        parts = self.cut.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def plain(self, text: str) -> int:
        total, at = 0, 0
        while at < len(text):
            # A blank between two printable characters always starts a pre-token, so long texts are cut there.
            after = BREAK.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = after.start() if after else len(text)
            total += sum(map(self.lengths.__getitem__, self.pattern.findall(text[at:end])))
            at = end
        return total


_WORKER: dict[tuple, TokenCounter] = {}


def worker_counter(path: str, pattern: str, table) -> TokenCounter:
    """One counter per worker process, table and vocabulary; it outlives the task."""
    key = (path, pattern, table.id if hasattr(table, "id") else id(table))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TokenCounter(path, pattern, table.value.lookup())
    return _WORKER[key]


@dataclass(frozen=True)
class Table:
    """Frequent pre-tokens, sorted, in one string of UTF-8, with the bytes and tokens of each."""

    keys: bytes
    sizes: np.ndarray
    tokens: np.ndarray

    def lookup(self) -> dict[str, int]:
        """The entries by pre-token, which a worker makes once."""
        ends = np.cumsum(self.sizes).tolist()
        return {
            self.keys[end - size : end].decode(): n
            for end, size, n in zip(ends, self.sizes.tolist(), self.tokens.tolist())
        }


def table_of(lengths: dict[str, int]) -> Table:
    keys = sorted(lengths)
    raw = [k.encode("utf-8") for k in keys]
    return Table(b"".join(raw), np.array([len(k) for k in raw], np.uint16), np.array([lengths[k] for k in keys], np.uint16))


def frequent_pre_tokens(documents: DataFrame, path: str, pattern: str, text: str = "text") -> Table:
    """The most frequent pre-tokens of about ``SAMPLE_TEXTS`` texts drawn from all rows, with their lengths.

    Every row may be drawn, a long text with a stretch that its digest chooses. Which texts they are changes the speed, not
    the counts.
    """
    import regex
    from tokenizers import Tokenizer

    rows = documents.select(F.col(text).alias("t")).where(F.octet_length("t") > 0)
    total = rows.count()
    start = 1 + F.pmod(F.xxhash64("t"), F.greatest(F.length("t") - SAMPLE_CHARS + 1, F.lit(1)))
    stretch = F.substr(F.col("t"), start.cast("int"), F.lit(SAMPLE_CHARS)).alias("t")
    sample = rows.sample(min(1.0, SAMPLE_TEXTS / max(total, 1)), seed=7).select(stretch)
    compiled, found = regex.compile(pattern), Counter()
    for row in sample.collect():
        found.update(compiled.findall(row["t"]))
    keys = [k for k, _ in found.most_common(TABLE_ENTRIES) if len(k) <= MAX_KEY]
    encoded = Tokenizer.from_file(path).encode_batch(keys, add_special_tokens=False)
    return table_of({k: len(e.ids) for k, e in zip(keys, encoded)})


def token_counter(documents: DataFrame, path: str, pattern: str, text: str = "text"):
    """A column function ``text -> long`` for the vocabulary at ``path``; null counts as empty, so 0 tokens.

    Special strings inside a text are one token each, as the tokenizer takes them by default. A text with a character that
    pattern and tokenizer class differently goes to the tokenizer whole. Long texts are split in pieces at places
    that cannot change a pre-token.
    """
    spark = documents.sparkSession
    importable(spark)
    table = spark.sparkContext.broadcast(frequent_pre_tokens(documents, path, pattern, text))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = worker_counter(path, pattern, table)
        for batch in batches:
            yield pa.array([counter.count(t.as_py() or "") for t in batch], pa.int64())

    return count


def counted_documents(documents: DataFrame, path: str, pattern: str, limit: int = 1024) -> DataFrame:
    """Per document its bytes, tokens and whether it has more than ``limit`` tokens. No row, empty result."""
    count = token_counter(documents, path, pattern)
    rows = documents.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        count("text").alias("n_tokens"),
    )
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
