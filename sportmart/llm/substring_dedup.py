"""Passages of ``WINDOW`` words that a document with a smaller id holds too, found with an FM-index per shard.

1. Every window of a document has a minimizer, the smallest hash of ``GRAM`` words in it; equal windows have equal ones. Only
   stretches whose minimizer two documents hold can repeat, and only these go on, cut in pieces.
2. A minimizer of very many documents (a common passage) would gather all their pieces. There, windows are counted by
   their own hash first and only repeated ones go on; copies of these are equal and fold to one.
3. Pieces are dealt to shards by minimizer, so all occurrences of a window meet. A shard indexes its distinct pieces
   and streams them through the index; matches of the full length give the smallest document of every window.
4. These come back to the documents as intervals of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm import rolling
from sportmart.llm.common import NO_ID, importable, staged
from sportmart.llm.fm_index import FmIndex

WINDOW = 50
GRAM = 16
#: Windows of a piece at most.
PIECE = 64
#: Words of a shard on average.
SHARD_WORDS = 1_000_000
#: Stretches of a minimizer from which its windows are counted one by one. Either way gives the same result.
COMMON = 2000


def runs(block: rolling.Block, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with the same minimizer, in one text: minimizer, first window, windows (``PIECE`` at most)."""
    grams, _ = block.grams(gram)
    least = rolling.sliding_least(grams, window - gram + 1)
    n = len(least)
    none = np.zeros(0, np.int64)
    if not n:
        return none.astype(np.uint64), none, none
    whole = block.texts[:n] == block.texts[window - 1 :][:n]
    fresh = np.ones(n, bool)
    fresh[1:] = (least[1:] != least[:-1]) | (block.texts[1:n] != block.texts[: n - 1]) | ~whole[:-1]
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(fresh, at, 0))
    fresh |= (at - start) % PIECE == 0
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, n))
    kept = whole[first]
    return least[first][kept], first[kept], size[kept]


def emit_minimizers(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for block in rolling.blocks(texts, rolling.WHITE):
                key, first, _ = runs(block, window, gram)
                # A stretch may go on behind a cut; one row per text and key is enough.
                pairs = pd.DataFrame({"key": key.view(np.int64), "row": block.texts[first]}).drop_duplicates()
                rows = pa.array(pairs["row"].to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs["key"].to_numpy()), batch.column("id").take(rows), batch.column("text_hash").take(rows)],
                    ["key", "id", "text_hash"],
                )

    return run


PIECES = "id long, text_hash long, key long, common boolean, first long, words string"


def packed():
    """A column function that compresses bytes, for texts that are shuffled whole."""

    @F.arrow_udf("binary")
    def pack(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for text in texts:
            yield pa.array([None if t is None else press(t) for t in text.to_pylist()], pa.binary())

    return pack


def unpacked(column: pa.Array) -> Iterator[bytes]:
    import zstandard

    spread = zstandard.ZstdDecompressor().decompress
    return (b"" if t is None else spread(t) for t in column.to_pylist())


def emit_pieces(window: int, gram: int):
    """Packed texts with the minimizers that go on in, their pieces out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(unpacked(batch.column("text")))
            wanted = [np.array(k, np.int64) for k in batch.column("keys").to_pylist()]
            common = [set(k) for k in batch.column("common").to_pylist()]
            for block in rolling.blocks(texts, rolling.WHITE):
                key, first, size = runs(block, window, gram)
                key, text = key.view(np.int64), block.texts[first]
                # Words are numbered from 0 in each text, of which the block holds all.
                offset = np.searchsorted(block.texts, text)
                out = []
                for t in np.unique(text).tolist():
                    own = slice(*np.searchsorted(text, [t, t + 1]))
                    for i in (np.flatnonzero(np.isin(key[own], wanted[t])) + own.start).tolist():
                        words = block.joined(int(first[i]), int(size[i]) + window - 1)
                        out.append((t, int(key[i]), int(key[i]) in common[t], int(first[i] - offset[i]), words))
                if out:
                    rows = pa.array([o[0] for o in out])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(rows), batch.column("text_hash").take(rows),
                            pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.bool_()),
                            pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.string()),
                        ],
                        ["id", "text_hash", "key", "common", "first", "words"],
                    )

    return run


def emit_windows(window: int):
    """The hash of every window of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("utf-8") for w in batch.column("words").to_pylist()]
            for block in rolling.blocks(texts, rolling.WHITE):
                hashes, whole = block.grams(window)
                at = np.flatnonzero(whole)
                rows = pa.array(block.texts[at])
                shift = at - np.searchsorted(block.texts, block.texts[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(rows), batch.column("text_hash").take(rows), batch.column("first").take(rows),
                        pa.array(shift, pa.int64()), pa.array(hashes[at].view(np.int64)),
                    ],
                    ["id", "text_hash", "first", "shift", "hash"],
                )

    return run


def emit_cuts(window: int):
    """Pieces with the places of their windows that go on in, one piece per stretch of these out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, first, words = [], [], []
            starts = batch.column("first").to_pylist()
            for i, (text, shifts) in enumerate(zip(batch.column("words").to_pylist(), batch.column("shifts").to_pylist())):
                split = text.split(" ")
                shifts = sorted(shifts)
                begin = 0
                for k in range(1, len(shifts) + 1):
                    if k == len(shifts) or shifts[k] != shifts[k - 1] + 1:
                        rows.append(i)
                        first.append(starts[i] + shifts[begin])
                        words.append(" ".join(split[shifts[begin] : shifts[k - 1] + window]))
                        begin = k
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at), batch.column("text_hash").take(at), batch.column("key").take(at),
                    pa.array(first, pa.int64()), pa.array(words, pa.string()),
                ],
                ["id", "text_hash", "key", "first", "words"],
            )

    return run


def match_shard(window: int):
    """Distinct pieces of one shard in; per piece the stretches of windows and the smallest id that holds them out."""

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        columns = ["key", "digest", "shift", "windows", "holder"]
        pieces = pieces.sort_values(["holder", "key", "digest"], kind="stable")
        split = [w.split(" ") for w in pieces["words"]]
        sizes = np.array([len(w) for w in split])
        codes = pd.factorize(np.array([w for s in split for w in s], dtype=object))[0] + 1
        # A zero behind every piece.
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        sequence = np.zeros(int(ends[-1]) + 1, np.int64)
        place = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)
        sequence[place] = codes
        index = FmIndex(sequence, window)
        length, low, _ = index.matching_statistics(sequence, starts, ends)
        # The smallest id over the interval of a match; intervals of full matches are the index's classes.
        piece = np.repeat(np.arange(len(sizes)), sizes + 1)
        holder = pieces["holder"].to_numpy()
        least = np.minimum.reduceat(holder[piece[index.suffixes]], index.class_starts[:-1])
        full = np.flatnonzero(length == window)
        first = least[index.class_of[low[full]]]
        own = piece[full]
        fresh = np.ones(len(full), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (first[1:] != first[:-1]) | (full[1:] != full[:-1] + 1)
        begin = np.flatnonzero(fresh)
        return pd.DataFrame(
            {
                "key": pieces["key"].to_numpy()[own[begin]], "digest": pieces["digest"].to_numpy()[own[begin]],
                "shift": full[begin] - starts[own[begin]], "windows": np.diff(np.append(begin, len(full))),
                "holder": first[begin],
            },
            columns=columns,
        )

    return run


def repeated_spans(
    documents: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text: str = "text", common: int = COMMON,
    shard_words: int = SHARD_WORDS, gram: int | None = None,
) -> DataFrame:
    """``id``, ``text_hash`` and ``spans`` (first word, words) of all texts that hold windows of a smaller id."""
    spark = documents.sparkSession
    importable(spark)
    gram = gram or max(1, min(GRAM, window // 2))
    rows = documents.select(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("binary").alias("text"),
    )
    found = staged(
        spark, rows.mapInArrow(emit_minimizers(window, gram), "key long, id long, text_hash long"), "minimizers"
    )
    several = found.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
    several = several.where("a < b").select("key", (F.col("n") > common).alias("common"))
    wanted = found.join(several, "key").groupBy("id", "text_hash").agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("common"), F.col("key"))).alias("common")
    )
    texts = rows.select("id", "text_hash", packed()("text").alias("text"))
    pieces = texts.join(wanted, ["id", "text_hash"]).select("id", "text_hash", "text", "keys", "common")
    pieces = pieces.mapInArrow(emit_pieces(window, gram), PIECES).withColumn("digest", F.xxhash64("words"))
    pieces = staged(spark, pieces, "pieces")

    often = pieces.where("common")
    windows = often.mapInArrow(emit_windows(window), "id long, text_hash long, first long, shift long, hash long")
    again = windows.groupBy("hash").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("hash")
    place = ["id", "text_hash", "first"]
    shifts = windows.join(again, "hash").groupBy(*place).agg(F.collect_set("shift").alias("shifts"))
    # Repeated rows hold the same pieces; one of them is enough.
    cuts = often.dropDuplicates(place).join(shifts, place).select(*place, "key", "words", "shifts")
    cuts = cuts.mapInArrow(emit_cuts(window), "id long, text_hash long, key long, first long, words string")
    cuts = staged(spark, cuts.withColumn("digest", F.xxhash64("words")), "cuts")
    held = pieces.where("NOT common").drop("common").unionByName(cuts)

    distinct = staged(
        spark, held.groupBy("key", "digest", "words").agg(F.min("id").alias("holder"), F.max("id").alias("last")), "distinct"
    )
    total = distinct.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    matched = dealt.select("shard", "key", "digest", "words", "holder").groupBy("shard").applyInPandas(
        match_shard(window), "key long, digest long, shift long, windows long, holder long"
    )
    # Of use only where some document behind the holder has the piece.
    last = distinct.select("key", "digest", "last")
    matched = matched.join(last, ["key", "digest"]).where("holder < last").drop("last")
    spans = held.select("id", "text_hash", "key", "digest", "first").join(matched, ["key", "digest"]).where("id > holder")
    span = F.struct((F.col("first") + F.col("shift")).alias("first"), (F.col("windows") + window - 1).alias("n"))
    return spans.groupBy("id", "text_hash").agg(F.collect_set(span).alias("spans"))


def without_spans():
    """A column function ``(packed bytes, spans)``: the words outside the spans, joined by a blank, and how many there were and went."""

    @F.arrow_udf("struct<n_words: long, n_removed: long, kept: string>")
    def left_over(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, spans in texts:
            counts, removed, kept = [], [], []
            for raw, own in zip(unpacked(text), spans.to_pylist()):
                words = raw.split()
                counts.append(len(words))
                if own:
                    left, at = [], 0
                    for s in sorted(own, key=lambda x: x["first"]):
                        left += words[at : max(at, s["first"])]
                        at = max(at, s["first"] + s["n"])
                    words = left + words[at:]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["n_words", "n_removed", "kept"],
            )

    return left_over


def dedup_substrings(documents: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by a blank).

    A word goes if it lies in a window of ``window`` words that a document with a smaller id holds too; windows are judged
    on the input. Words are split at space and U+0009 to U+000D. A null text has no words. Rows that share
    an id, or have none (they sort behind all others), do not take from each other. No row, empty result.
    """
    spans = repeated_spans(documents, window, **options)
    spans = spans.select(F.col("id").alias("__id"), F.col("text_hash").alias("__text"), "spans")
    rows = documents.select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.xxhash64("text").alias("__text"),
        packed()(F.col("text").cast("binary")).alias("text"),
    )
    joined = rows.join(spans, ["__id", "__text"], "left").select("doc_id", without_spans()("text", "spans").alias("x"))
    return joined.select("doc_id", "x.n_words", "x.n_removed", "x.kept")


def digested(documents: DataFrame) -> DataFrame:
    done = dedup_substrings(documents)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
