"""Documents that hold benchmark items, by greedy string tiling.

Documents and items meet where they share ``MIN_MATCH`` words in a row. For each such pair the longest matches that do not
overlap are marked again and again, found by running Karp-Rabin; the share of the item's words that end up
marked decides. Tiles may stand in any order, so an item whose sentences were moved around is found too.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm import rolling
from sportmart.llm.common import NO_ID, importable, staged
from sportmart.llm.license_scan import spaced_words

MIN_MATCH = 5
THRESHOLD = 0.8
#: First search length of the tiling.
SEARCH = 20
#: Bits of the filter for seeds: 2 MB, whatever the benchmark's size. A fuller filter lets more through to the join.
FILTER_BITS = 24


def windows_of(words: list[int], marked: list[bool], n: int) -> Iterator[tuple[int, int]]:
    """Start and rolling hash of every ``n`` unmarked words in a row."""
    modulus, base = (1 << 61) - 1, 1_000_003
    top = pow(base, n - 1, modulus)
    value = held = 0
    for i, word in enumerate(words):
        if marked[i]:
            value = held = 0
            continue
        if held == n:
            value = (value - words[i - n] * top) % modulus
            held -= 1
        value = (value * base + word) % modulus
        held += 1
        if held == n:
            yield i - n + 1, value


def tiles(item: list[int], text: list[int], least: int = MIN_MATCH, search: int = SEARCH) -> list[tuple[int, int, int]]:
    """``(start in item, start in text, length)`` of a greedy tiling by running Karp-Rabin.

    Each pass looks for matches of ``size`` words or more. A match of more than twice that starts the pass again with its
    length; else the pass marks its matches from the longest on, and the next one halves the size.
    """
    in_item, in_text = [False] * len(item), [False] * len(text)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(search, len(item)))
    while True:
        table = defaultdict(list)
        for t, h in windows_of(text, in_text, size):
            table[h].append(t)
        matches, longest = defaultdict(list), 0
        for p, h in windows_of(item, in_item, size) if table else ():
            for t in table.get(h, ()):
                n = 0
                while (
                    p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n]
                    and not in_item[p + n] and not in_text[t + n]
                ):
                    n += 1
                if n >= size:
                    matches[n].append((p, t))
                    longest = max(longest, n)
            if longest > 2 * size:
                break
        if longest > 2 * size:
            size = longest
            continue
        for n in range(longest, size - 1, -1):
            for p, t in matches.pop(n, ()):
                # Part of it may be marked by now; what is left at its start can be long enough.
                m = 0
                while m < n and not in_item[p + m] and not in_text[t + m]:
                    m += 1
                if m == n:
                    out.append((p, t, n))
                    in_item[p : p + n] = [True] * n
                    in_text[t : t + n] = [True] * n
                elif m >= size:
                    matches[m].append((p, t))
        if size <= least:
            return out
        size = max(least, size // 2)


def reachable(item: list[int], text: list[int], least: int) -> int:
    """Words of the item that any shared seed covers: no tiling can mark more."""
    seeds = {tuple(text[t : t + least]) for t in range(len(text) - least + 1)}
    covered, end = 0, 0
    for p in range(len(item) - least + 1):
        if tuple(item[p : p + least]) in seeds:
            covered += p + least - max(end, p)
            end = p + least
    return covered


def tile_pairs(least: int, threshold: float = 0.0):
    """Rows of an item's words and a text's segments in, the tiling's figures out; zeros where ``threshold`` cannot be reached."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, segments in zip(batch.column("words").to_pylist(), batch.column("segments").to_pylist()):
                number: dict[str, int] = {}
                code = [number.setdefault(w, len(number) + 1) for w in item.split(" ")]
                text: list[int] = []
                for segment in segments:
                    # Words of no item and the gaps between segments match nothing.
                    text += [number.get(w, 0) for w in segment.split(" ")] + [0]
                found = tiles(code, text, least) if reachable(code, text, least) >= threshold * len(code) else []
                rows.append((sum(n for _, _, n in found), len(found), max((n for _, _, n in found), default=0), len(code)))
            figures = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            kept = [batch.column(k) for k in ("item_key", "profile")]
            yield pa.RecordBatch.from_arrays([*kept, *figures], ["item_key", "profile", "marked", "tiles", "longest", "size"])

    return run


def seed_hashes(least: int):
    """Seeds of normalised texts as slots of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "replace") for t in batch.column(0).to_pylist()]
            for block in rolling.blocks(texts, rolling.PUNCTUATION, lower=True):
                hashes, whole = block.grams(least)
                slots = np.unique(hashes[whole] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slots)], ["slot"])

    return run


def seed_filter(items: DataFrame, least: int) -> np.ndarray:
    """A bit per slot that holds a seed of an item, packed. At most 2**FILTER_BITS / 64 numbers reach the driver."""
    slots = items.select("words").mapInArrow(seed_hashes(least), "slot long")
    bit = F.expr("shiftleft(1L, cast(slot % 64 AS int))")
    packed = slots.groupBy(F.expr("slot div 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    for row in packed.collect():
        out[row["at"]] = row["bits"]
    return out.view(np.uint8)


def segments_of(filter_broadcast, least: int):
    """Per text the stretches of words whose every seed passes the filter; texts without any give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = filter_broadcast.value
        for batch in batches:
            found: dict[int, list[str]] = defaultdict(list)
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for block in rolling.blocks(texts, rolling.PUNCTUATION, lower=True):
                hashes, whole = block.grams(least)
                slot = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                hit = np.flatnonzero(((packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool) & whole)
                if not len(hit):
                    continue
                fresh = np.concatenate([[True], (np.diff(hit) > 1) | (block.texts[hit[1:]] != block.texts[hit[:-1]])])
                first = np.flatnonzero(fresh)
                last = np.append(first[1:], len(hit)) - 1
                for a, b in zip(hit[first].tolist(), hit[last].tolist()):
                    found[int(block.texts[a])].append(block.joined(a, b - a + least))
            at = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(at, pa.int64())) for k in ("id", "text_hash")]
                + [pa.array([found[i] for i in at], pa.list_(pa.string()))],
                ["id", "text_hash", "segments"],
            )

    return run


def telling_seeds(item_seeds: DataFrame, text_seeds: DataFrame, least: int, threshold: float) -> DataFrame:
    """``item_key``, ``seed`` of those seeds of each item by which any text that covers enough of it must meet it.

    A text that covers ``threshold`` of an item's words leaves few uncovered; so of one word more than those in a row, one is covered,
    by a seed that reaches it. Of all such stretches of the item the one whose seeds are in the fewest texts is taken, so a
    seed that many items and many texts share joins them only if the item has nothing rarer.
    """
    common = text_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("texts"))
    counted = item_seeds.join(common, "seed", "left").select(
        "item_key", "size", F.struct("at", F.coalesce("texts", F.lit(0)).alias("texts"), "seed").alias("s")
    )
    # An item's seeds are as many as its words.
    items = counted.groupBy("item_key", "size").agg(F.array_sort(F.collect_list("s")).alias("seeds"))
    reach = (F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1).cast("int") + least - 1
    width = F.least(reach, F.size("seeds"))
    starts = F.sequence(F.lit(1), F.size("seeds") - width + 1)
    costs = F.transform(
        starts,
        lambda a: F.struct(
            F.aggregate(F.slice("seeds", a, width), F.lit(0).cast("long"), lambda n, s: n + s["texts"]).alias("cost"), a.alias("a")
        ),
    )
    items = items.withColumn("start", F.array_min(costs)["a"])
    return items.select("item_key", F.explode(F.slice("seeds", F.col("start"), width)).alias("s")).select("item_key", "s.seed").distinct()


def contaminated(
    documents: DataFrame, benchmark: DataFrame, least: int = MIN_MATCH, threshold: float = THRESHOLD,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``id``, ``text_hash``, ``item_id``, ``coverage``, ``tiles`` and ``longest`` of every document and item whose tiles of ``least`` words
    or more cover ``threshold`` of the item's words.

    Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z. An item of fewer than ``least`` words
    is found where all its words stand in a row: a pass over the documents for each such length that there is. Null texts
    and items, and items without a word, are never found. Only stretches of a document that pass
    a filter of fixed size for the items' seeds leave the task that read it; no tile can reach outside them. Documents
    with the same stretches are tiled once. Rows without an id sort behind all others (``id`` is ``NO_ID``).
    """
    spark = documents.sparkSession
    importable(spark)
    items = benchmark.select("item_id", spaced_words(F.col("text")).alias("words")).distinct()
    size = F.size(F.split("words", " "))
    items = items.withColumn("item_key", F.md5(F.concat_ws("|", "item_id", "words"))).where("words <> ''")
    items = staged(spark, items.withColumn("least", F.least(size, F.lit(least))), "items")
    # At most ``least`` lengths.
    lengths = sorted({r["least"] for r in items.select("least").distinct().collect()} | {least})
    rows = documents.select(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    )
    found = None
    for n in lengths:
        own = items.where(F.col("least") == n).drop("least")
        part = holders(rows, own, n, threshold)
        found = part if found is None else found.unionByName(part)
    return found


def holders(rows: DataFrame, items: DataFrame, least: int, threshold: float) -> DataFrame:
    """``contaminated`` for items of ``least`` words or more."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(seed_filter(items, least))
    held = rows.mapInArrow(segments_of(shared, least), "id long, text_hash long, segments array<string>")
    held = staged(spark, held.withColumn("profile", F.md5(F.array_join("segments", "\n"))), "segments")
    profiles = held.groupBy("profile", "segments").agg(F.count(F.lit(1)).alias("copies")).drop("copies")

    def seeds(words):
        places = F.when(F.size(words) >= least, F.sequence(F.lit(1), F.size(words) - least + 1))
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.array_join(F.slice(words, i, F.lit(least)), " ").alias("seed")))

    item_seeds = items.select("item_key", F.split("words", " ").alias("w"))
    item_seeds = item_seeds.select("item_key", F.size("w").alias("size"), F.inline(seeds(F.col("w"))))
    text_seeds = profiles.select("profile", F.explode("segments").alias("segment"))
    text_seeds = text_seeds.select("profile", F.split("segment", " ").alias("w"))
    text_seeds = text_seeds.select("profile", F.inline(seeds(F.col("w")))).select("profile", "seed").distinct()
    text_seeds = staged(spark, text_seeds, "seeds")
    telling = telling_seeds(item_seeds, text_seeds, least, threshold)
    pairs = text_seeds.join(telling, "seed").select("profile", "item_key").distinct()
    pairs = pairs.join(profiles, "profile").join(items.select("item_key", "words"), "item_key")
    tiled = pairs.select("item_key", "profile", "words", "segments").mapInArrow(
        tile_pairs(least, threshold), "item_key string, profile string, marked long, tiles long, longest long, size long"
    )
    tiled = tiled.withColumn("coverage", F.col("marked") / F.col("size")).where(F.col("coverage") >= threshold)
    tiled = tiled.join(items.select("item_key", "item_id"), "item_key")
    # Not broadcast by hint: a profile of a common passage is split by adaptive execution.
    return held.join(tiled, "profile").select("id", "text_hash", "item_id", "coverage", "tiles", "longest")


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item."""
    return contaminated(documents, benchmark).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "item_id", "coverage", "tiles", "longest"
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` less those that hold an item; columns stay as they are."""
    bad = contaminated(documents, benchmark).select(F.col("id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("__row"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.xxhash64("text").alias("__text"),
    )
    kept = rows.join(bad, ["__id", "__text"], "left_anti")
    return kept.select(*(F.col(f"__row.`{c}`").alias(c) for c in documents.columns))
