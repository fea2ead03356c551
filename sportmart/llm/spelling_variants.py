"""Spelling variants: words one edit apart, found by a scan of sorted word lists that shares rows of the edit matrix.

Two words at one edit whose shorter one has n letters agree in their first n // 2 letters or in their last ones. So words
meet in groups by that beginning, and, read backwards, by that end. A group is a sorted list; the edit matrix of a wanted
word against the list keeps its rows for the prefix that a word shares with the one before it, holds
only the three cells of a row that one edit can reach, and a prefix whose cells all exceed one edit skips every word that
goes on from it.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm.common import importable, staged

#: Letters of a run: ASCII letters and U+00C0 to U+00FF.
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH = 6
MIN_COUNT = 5
#: Of so many distinct (document, run) pairs one loses a letter.
ONE_IN = 199
#: A form is that many times as frequent as its variant.
RATIO = 5
#: Distinct words and letters that a task counts at a time, and words of one group that one block holds.
HELD_WORDS = 200_000
HELD_LETTERS = 16_000_000
BLOCK = 16_384


def runs_of(text: bytes) -> Counter:
    """Runs of letters with their number; A-Z lower-cased, other letters left as they are."""
    return Counter(RUNS.findall(text.lower().decode("utf-8", "replace")))


def damaged(doc_id, run: str) -> str:
    """The run as it counts: one (document, run) in ``ONE_IN`` loses the letter that its CRC-32 says."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of at least ``MIN_LENGTH`` letters with their number among the rows that a task has read so far."""
    held: Counter = Counter()
    letters = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for run, n in runs_of(text.as_py() or b"").items():
                if len(run) >= MIN_LENGTH and len(word := damaged(doc_id, run)) >= MIN_LENGTH:
                    held[word] += n
                    letters += len(word)
            if len(held) > HELD_WORDS or letters > HELD_LETTERS:
                yield out()
                held.clear()
                letters = 0
    if held:
        yield out()


def vocabulary(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of words that occur ``MIN_COUNT`` times in all documents."""
    importable(documents.sparkSession)
    rows = documents.select(F.col(id_column), F.col(text).cast("binary"))
    parts = rows.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def keyed(words: DataFrame) -> DataFrame:
    """Each word under the keys by which it can meet others: of a pair whose shorter word has ``size`` letters it is the
    shorter (or an equal) one, ``wanted``, or the one with a letter more."""
    length = F.length("word")
    sides = words.select("word", "n", F.lit(False).alias("back")).unionByName(
        words.select(F.reverse("word").alias("word"), "n", F.lit(True).alias("back"))
    )
    sides = sides.select("word", "n", "back", F.explode(F.array(length, length - 1)).alias("size"))
    # A key is half as long as the shorter word; there are no words shorter than MIN_LENGTH.
    return sides.where(F.col("size") >= MIN_LENGTH).select(
        "back", "size", F.expr("left(word, size div 2)").alias("start"), "word", "n",
        (F.length("word") == F.col("size")).alias("wanted"),
    )


def dealt(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Groups sorted for ``scanned``: ``listed`` words come before the ``wanted`` ones. A group of more than ``block`` words becomes a
    square of blocks: each word is listed in one column and wanted in one row, so every two words meet once."""
    keys = ["back", "size", "start"]
    rows = keyed(words)
    large = rows.groupBy(*keys).count().where(F.col("count") > block)
    sides = F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("int")
    rows = rows.join(large, keys, "left").withColumn("sides", sides)
    place = F.pmod(F.xxhash64("word"), F.col("sides")).cast("int")
    every = F.sequence(F.lit(0), F.col("sides") - 1)
    listed = rows.select(*keys, place.alias("column"), F.explode(every).alias("row"), F.lit(False).alias("wanted"), "word", "n")
    wanted = rows.where("wanted").select(
        *keys, F.explode(every).alias("column"), place.alias("row"), F.lit(True).alias("wanted"), "word", "n"
    )
    group = [*keys, "column", "row"]
    # A row costs far more than its bytes, so partitions are not put together by their size.
    many = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.unionByName(wanted).repartition(many, *group).sortWithinPartitions(*group, "wanted", "word")


class SortedList:
    """Sorted distinct words with the prefixes that neighbours share, and for each depth the places where a new prefix begins."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shared = [0] + [common(a, b) for a, b in zip(words, words[1:])]
        self.begins: dict[int, list[int]] = {}

    def after(self, i: int, depth: int) -> int:
        """The next place whose word does not share ``depth`` letters with word ``i``."""
        if i + 1 < len(self.words) and self.shared[i + 1] < depth:
            return i + 1
        if depth not in self.begins:
            self.begins[depth] = [j for j, n in enumerate(self.shared) if n < depth] + [len(self.words)]
        return self.begins[depth][bisect_right(self.begins[depth], i)]

    def one_edit(self, wanted: str, low: int) -> list[int]:
        """Places of the words at exactly one edit from ``wanted``; all words begin with its first ``low`` letters.

        Row k of the edit matrix is that of a word's first k letters; only its cells k - 1, k and k + 1 can be one or
        less. The rows of the prefix shared with the word scanned last stay; where all three cells exceed
        one, every word with that prefix is skipped.
        """
        words, shared, n = self.words, self.shared, len(wanted)
        found, rows = [], [(1, 0, 1)] * (low + 1)
        if not low:
            rows = [(2, 0, 1)]
        i = 0
        while i < len(words):
            word = words[i]
            left, mid, right = rows[-1]
            for k in range(len(rows), len(word) + 1):
                letter = word[k - 1]
                a = min(left + (k < 2 or wanted[k - 2] != letter), mid + 1) if k <= n + 1 else 2
                b = min(mid + (wanted[k - 1] != letter), right + 1, a + 1) if k <= n else 2
                c = min(right + (wanted[k] != letter), b + 1) if k < n else 2
                if a > 1 and b > 1 and c > 1:
                    at = self.after(i, k)
                    break
                left, mid, right = a, b, c
                rows.append((a, b, c))
            else:
                if -1 <= n - len(word) <= 1 and rows[len(word)][n - len(word) + 1] == 1:
                    found.append(i)
                at = i + 1
            if at < len(words):
                # Words skipped share more with the last one than the next does with them.
                del rows[max(shared[at], low) + 1 :]
            i = at
        return found


def common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted groups in; out, per group and word, how many words are near and the best of these.

    Only the listed words of one group are held. A pair of equal lengths is found from both words, another from the shorter
    one alone; a pair that agrees in the first half too is left to the group of that half.
    """
    group, words, counts, index, size, back = None, [], [], None, 0, False
    longer: dict[str, list] = {}
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["word", "near", "near_n", "near_word"]
        )

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(8)]
        for *key, wanted, word, n in zip(*columns):
            if key != group:
                out += [(w, *x) for w, x in longer.items()]
                group, words, counts, index, longer = key, [], [], None, {}
                back, size = key[:2]
            if not wanted:
                words.append(word)
                counts.append(n)
                continue
            if not words or words == [word]:
                continue
            index = index or SortedList(words)
            half = size // 2
            own = word[::-1] if back else word
            best, near = None, 0
            for at in index.one_edit(word, half):
                other = words[at]
                if back and other[-half:] == word[-half:]:
                    continue
                other = other[::-1] if back else other
                near += 1
                best = min(best or (0, ""), (-counts[at], other))
                if len(other) > size:
                    seen = longer.get(other, (0, 0, ""))
                    longer[other] = (seen[0] + 1, *min((seen[1], seen[2]), (-n, own)))
            if near:
                out.append((own, near, *best))
        if len(out) > 20_000:
            yield batch_of()
            out = []
    out += [(w, *x) for w, x in longer.items()]
    if out:
        yield batch_of()


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word``, ``n_near`` and the most frequent near word (``near_word``, ``near_n``; ties: the least in code-point order) of words that have any."""
    parts = dealt(words, block).mapInArrow(scanned, "word string, near long, near_n long, near_word string")
    best = parts.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("near_n", "near_word")).alias("best"))
    return best.select("word", "n_near", F.negative("best.near_n").alias("near_n"), "best.near_word")


def roots(forms: DataFrame) -> DataFrame:
    """The last form that each ``word`` leads to, by pointer doubling: every round halves the way. A form is at least ``RATIO`` times
    as frequent as its word, so ways are short."""
    state = forms.select("word", F.col("form").alias("root"))
    while True:
        state = staged(forms.sparkSession, state, "roots")
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(further, "root")
        if moved.isEmpty():
            return state
        state = state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variants(documents: DataFrame, id_column: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of ``documents`` (whole texts).

    Words are maximal runs of letters, lower-cased in A-Z, after the trial damage of ``damaged``; those of ``MIN_LENGTH`` code
    points or more that occur ``MIN_COUNT`` times or more. Null and empty texts have none; a null id counts as an empty one. Repeated rows
    count as often as they stand there. No word, no row. Other columns are not read.
    """
    spark = documents.sparkSession
    words = staged(spark, vocabulary(documents, id_column, text), "words")
    known = words.join(near_words(words, block), "word", "left")
    frequent = F.col("near_n") >= RATIO * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("near_word")).alias("form"), F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    known = staged(spark, known, "forms")
    lead = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(lead, "word", "left").withColumn("root", F.coalesce("root", "word"))
