"""Repeated passages of whole lines, found as chunks whose boundaries the content chooses and joined line by line.

A chunk is two neighbouring lines with words. A rolling hash over their line hashes chooses which neighbours are one: those
whose hash is divisible by ``mean``. The choice looks at the two lines alone, so a passage is cut alike wherever it stands,
from its first line to its last. With a mean of one every pair is a chunk, and a shared passage of two lines is
found for sure; a larger mean compares fewer chunks and finds longer passages only.
Repeated chunks that overlap or touch grow into one passage, which goes if it has enough words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportmart.llm.common import BLANKS, NO_ID, let, staged

#: Factor and modulus of the rolling hash, lines from one chunk to the next in the mean, and words of a passage that goes.
FACTOR = 1_000_003
MODULUS = 2_147_483_647
MEAN_LINES = 1
MIN_WORDS = 10
LINES = "array<struct<at: int, line: string, words: int>>"


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def words_in(line: Column) -> Column:
    return F.size(F.split(F.btrim(line, F.lit(BLANKS)), r"[ \x09-\x0D]+"))


def lines_of(text: Column) -> Column:
    """Lines with a word: where they stand among all lines, and how many words they have. Blank lines belong to no chunk, and go
    with the passage around them."""
    def some(lines: Column) -> Column:
        placed = F.transform(
            lines, lambda line, i: F.struct(i.alias("at"), line.alias("line"), words_in(line).cast("int").alias("words"))
        )
        return F.filter(placed, lambda x: F.btrim(x["line"], F.lit(BLANKS)) != "")

    return let(F.split(F.coalesce(text, F.lit("")), "\n", -1), some)


def chunks_of(lines: Column, mean: int = MEAN_LINES) -> Column:
    """The chunks as (number of their first line among ``lines``, text)."""
    def pair(i: Column) -> Column:
        return F.struct(
            (i - 1).alias("i"), F.concat(F.get(lines, i - 1)["line"], F.lit("\n"), F.get(lines, i)["line"]).alias("chunk")
        )

    places = F.when(F.size(lines) > 1, F.sequence(F.lit(1), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
    if mean > 1:
        def chosen(hashes: Column) -> Column:
            return F.filter(
                places, lambda i: (F.get(hashes, i) * FACTOR + F.get(hashes, i - 1)) % MODULUS % mean == 0
            )

        places = let(F.transform(lines, lambda x: line_hash(x["line"])), chosen)
    return F.transform(places, pair)


def seen_before(chunks: Column, gone: Column) -> Column:
    """Numbers of the chunks whose digest is in ``gone``, or that repeat an earlier one of the same text which they do not overlap.

    Sorted by digest and place, the digests of ``gone`` stand before all chunks that have them. A chunk goes if one stands
    before it, unless that is the first one of the text and the line before it: the two share a line, and one must stay.
    """
    marks = F.transform(gone, lambda d: F.struct(d.alias("d"), F.lit(-9).alias("i")))
    own = F.transform(chunks, lambda c: F.struct(F.md5(c["chunk"]).alias("d"), c["i"].cast("int").alias("i")))

    def judged(entries: Column) -> Column:
        def one(e: Column, j: Column) -> Column:
            last, before = F.get(entries, j - 1), F.get(entries, j - 2)
            again = F.coalesce(last["d"] == e["d"], F.lit(False))
            overlapping = (last["i"] + 1 == e["i"]) & ~F.coalesce(before["d"] == e["d"], F.lit(False))
            return F.when((e["i"] >= 0) & again & ~overlapping, e["i"])

        return F.filter(F.transform(entries, one), lambda i: i.isNotNull())

    return F.array_sort(let(F.array_sort(F.concat(marks, own)), judged))


def passages(seen: Column, lines: Column, least: int) -> Column:
    """Runs of seen chunks that overlap or touch, as (first line, last line) among ``lines``, with ``least`` words or more."""
    def runs(places: Column) -> Column:
        starts = F.filter(places, lambda i, j: F.coalesce(i - F.get(places, j - 1) > 2, F.lit(True)))
        ends = F.filter(places, lambda i, j: F.coalesce(F.get(places, j + 1) - i > 2, F.lit(True)))
        spans = F.transform(starts, lambda a, j: F.struct(a.alias("a"), (F.get(ends, j) + 1).alias("b")))
        counted = lambda s: F.aggregate(
            F.slice(lines, s["a"] + 1, s["b"] - s["a"] + 1), F.lit(0), lambda n, x: n + x["words"]
        )
        return F.filter(spans, lambda s: counted(s) >= least)

    return let(seen, runs)


def without(text: Column, lines: Column, gone: Column, mean: int, least: int) -> Column:
    """The text less its repeated passages."""
    def cut(own: Column) -> Column:
        spans = passages(seen_before(chunks_of(own, mean), gone), own, least)
        removed = F.flatten(F.transform(spans, lambda s: F.sequence(F.get(own, s["a"])["at"], F.get(own, s["b"])["at"])))

        def left(all_lines: Column) -> Column:
            places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), removed)
            return F.array_join(F.transform(places, lambda i: F.get(all_lines, i)), "\n")

        return F.when(F.size(spans) > 0, let(F.split(text, "\n", -1), left)).otherwise(text)

    return let(lines, cut)


def held_chunks(documents: DataFrame, id_column: str, text: str, mean: int) -> DataFrame:
    rows = documents.select(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("id"),
        F.explode(let(lines_of(F.col(text)), lambda lines: chunks_of(lines, mean))).alias("c"),
    )
    return rows.select("id", F.col("c.chunk").alias("chunk"))


def repeated_chunks(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", mean: int = MEAN_LINES
) -> DataFrame:
    """``digest`` and ``first`` (smallest id) of every chunk that two documents hold.

    Grouping is by digest and chunk, so chunks are compared byte by byte, and copies meet one another in the
    task that read them before they are shuffled. A digest that stands for two chunks is left out.
    """
    held = held_chunks(documents, id_column, text, mean).withColumn("digest", F.md5("chunk"))
    same = held.groupBy("digest", "chunk").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    by_digest = same.groupBy("digest").agg(
        F.count(F.lit(1)).alias("chunks"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return by_digest.where("chunks = 1 AND first < last").select("digest", "first")


def chunks_to_drop(
    documents: DataFrame, repeated: DataFrame, id_column: str = "doc_id", text: str = "text", mean: int = MEAN_LINES
) -> DataFrame:
    """Per id the digests of chunks that a document with a smaller id holds too."""
    held = held_chunks(documents, id_column, text, mean).select("id", F.md5("chunk").alias("digest")).distinct()
    # Not broadcast by hint: repeated chunks grow with the input. Adaptive execution splits a hot digest.
    known = held.join(repeated, "digest").where(F.col("id") > F.col("first"))
    return known.groupBy("id").agg(F.collect_set("digest").alias("gone"))


def dedup_lines(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", mean: int = MEAN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """``documents`` with ``text`` less its repeated passages, ``n_lines`` and ``n_removed`` (lines).

    A passage is a run of chunks that documents with smaller ids hold too, or that stand earlier in the same text; it
    has two lines with words at least, and ``min_words`` words or it stays. What remains of a chunk's places is the first one
    in the document with the smallest id. Single lines stay. A null text stays null, an empty one empty.
    Rows that share an id, or have none, count as one document: both keep what is first there.
    Other columns are carried along unchanged, whatever their names; columns named like the added ones are replaced.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("__row"),
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("__id"),
    )
    repeated = staged(spark, repeated_chunks(documents, id_column, text, mean), "chunks")
    drop = chunks_to_drop(documents, repeated, id_column, text, mean).select(F.col("id").alias("__id"), "gone")
    joined = rows.join(drop, "__id", "left")
    value = F.col(f"__row.`{text}`")
    gone = F.coalesce(F.col("gone"), F.array().cast("array<string>"))
    done = joined.select("__row", without(value, lines_of(value), gone, mean, min_words).alias("__text"))
    lines = F.when(value.isNull(), 0).otherwise(line_count(value))
    # A text of which nothing remains has no line left.
    left = F.when(F.coalesce(F.col("__text"), F.lit("")) == "", 0).otherwise(line_count(F.col("__text")))
    columns = [c for c in documents.columns if c not in (text, "n_lines", "n_removed")]
    changed = F.col("__text") != value
    return done.select(
        *(F.col(f"__row.`{c}`").alias(c) for c in columns), F.col("__text").alias(text),
        lines.cast("long").alias("n_lines"),
        F.when(changed, lines - left).otherwise(0).cast("long").alias("n_removed"),
    )


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
