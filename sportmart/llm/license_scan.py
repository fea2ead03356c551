"""Licence notices in texts: fixed phrases, and an exact set-similarity join of text blocks with notice templates."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportmart.llm.common import NO_ID, let, lower_ascii, staged

# Phrases and labels of the base rules.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Wordings of public licence notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance"
                 " with the License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
            " General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

#: Templates are literals of the plan and their index is broadcast, so their number is bounded; callers may set another bound.
MAX_TEMPLATES = 1000
THRESHOLD = 0.8
#: Consecutive lines that make a block: notices are wrapped.
BLOCK_LINES = 3
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """Words in lower case (A-Z only), joined by one space; other ASCII than letters and digits separates."""
    return F.btrim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))


def notice_words(text: str) -> list[str]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [w for w in re.split(NOT_WORD, text.translate(lower)) if w]


def template_words(templates, most: int = MAX_TEMPLATES) -> list[tuple[str, frozenset[str]]]:
    if len(templates) > most:
        raise ValueError(f"more than {most} templates")
    parted = [(label, frozenset(notice_words(text))) for label, text in templates]
    return [(label, words) for label, words in parted if words]


def strings(values) -> Column:
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"array({quoted})").cast("array<string>")


def token_order(documents: DataFrame, vocabulary: list[str], text: str = "text") -> list[str]:
    """Words of the templates, rarest first by the number of texts of the whole input that hold them; ties by the word.

    A word outside the templates can be in no overlap, so no other word is counted.
    """
    words = F.split(spaced_words(F.col(text)), " ")
    return rarest_first(documents.select(F.array_intersect(words, strings(vocabulary)).alias("held")), vocabulary)


def rarest_first(texts: DataFrame, vocabulary: list[str]) -> list[str]:
    """The words of ``vocabulary`` by the number of rows whose ``held`` lists them."""
    found = texts.select(F.explode("held").alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_index(spark, templates, order: list[str], threshold: float) -> DataFrame:
    """One row per template and word of its prefix: overlap ``need`` cannot be reached without one of the
    ``size - need + 1`` rarest words."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for i, (label, words) in enumerate(templates):
        tokens = sorted(words, key=rank.__getitem__)
        need = needed(len(tokens), threshold)
        for at, token in enumerate(tokens[: len(tokens) - need + 1]):
            rows.append((token, i, label, at, tokens, need))
    return spark.createDataFrame(
        rows, "token string, template int, label string, place int, tokens array<string>, need int"
    )


def matching_blocks(
    documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block_lines: int = BLOCK_LINES,
    keys=("doc_id",), text: str = "text", order: list[str] | None = None, max_templates: int = MAX_TEMPLATES,
) -> DataFrame:
    """Every block of up to ``block_lines`` consecutive lines that holds ``threshold`` of a template's distinct words:
    the ``keys``, ``line`` (of the block's start), ``label`` and ``containment``.

    Blocks keep only template words, rarest first. A block meets a template where they share a word of the
    template's prefix; the length filter asks for ``need`` words, the positional filter for enough words
    behind the first shared one on both sides, and what passes is compared word by word.
    Null and empty texts have no block. Equal rows give equal results.
    """
    parted = template_words(templates, max_templates)
    vocabulary = sorted(set().union(*(w for _, w in parted))) if parted else []
    spark = documents.sparkSession
    order = token_order(documents, vocabulary, text) if order is None else order
    index = template_index(spark, parted, order, threshold)
    hot = sorted({r for _, words in parted for r in prefix(words, order, threshold)})
    ranked = strings(order)
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    per_line = F.transform(lines, lambda x: F.array_intersect(F.split(spaced_words(x), " "), strings(vocabulary)))

    def block(parts: Column) -> Column:
        return F.transform(
            parts,
            lambda _, i: F.array_distinct(F.flatten(F.slice(parts, i + 1, F.lit(block_lines)))),
        )

    rows = documents.where(F.arrays_overlap(F.split(spaced_words(F.col(text)), " "), strings(hot)))
    rows = rows.select(*keys, let(per_line, block).alias("blocks"))
    rows = rows.select(*keys, F.posexplode("blocks").alias("line", "words"))
    rows = rows.where(F.arrays_overlap("words", strings(hot)))
    # Rarest first: the global order filtered to the block's words.
    rows = rows.withColumn("words", F.array_intersect(ranked, F.col("words")))
    pairs = rows.withColumn("token", F.explode(F.array_intersect("words", strings(hot))))
    # The index is as small as the given templates: at most MAX_TEMPLATES prefixes.
    pairs = pairs.join(F.broadcast(index), "token")
    at = (F.array_position("words", F.col("token")) - 1).cast("int")
    left_block, left_template = F.size("words") - at, F.size("tokens") - F.col("place")
    first = F.get(F.array_intersect("tokens", "words"), F.lit(0)) == F.col("token")
    pairs = pairs.where(
        (F.size("words") >= F.col("need")) & (F.least(left_block, left_template) >= F.col("need")) & first
    )
    shared = F.size(F.array_intersect("words", "tokens"))
    pairs = pairs.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    return pairs.select(*keys, "line", "label", (F.col("shared") / F.size("tokens")).alias("containment"))


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def window_templates(templates, threshold: float, most: int = MAX_TEMPLATES) -> list[tuple[str, frozenset[str], int]]:
    """Label, words and width of a window: the template's length in words divided by ``threshold``."""
    sizes = [n for n in (len(notice_words(text)) for _, text in templates) if n]
    parted = template_words(templates, most)
    return [(label, words, math.ceil(n / threshold - 1e-9)) for (label, words), n in zip(parted, sizes)]


def matching_windows(
    documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, keys=("doc_id",), text: str = "text",
    order: list[str] | None = None, max_templates: int = MAX_TEMPLATES,
) -> DataFrame:
    """Every template of which some window of consecutive words, whatever their lines, holds ``threshold`` of the distinct
    words: the ``keys``, ``label`` and the greatest ``containment``. A window is as long as the template is in words,
    divided by ``threshold``: so many may be put between.

    A text meets a template where it holds a word of the template's prefix and ``need`` of its words. Windows begin
    at a template word; any other holds no more than the next of these. The length filter asks that the window reaches
    the ``need - 1``-th template word behind its first, the positional filter that enough of the template, in global
    order, lies behind the window's rarest word; the words of windows that pass both are counted.
    """
    given = window_templates(templates, threshold, max_templates)
    vocabulary = sorted(set().union(*(w for _, w, _ in given))) if given else []
    order = token_order(documents, vocabulary, text) if order is None else order
    rank = {w: i for i, w in enumerate(order)}
    each, hot = [], set()
    for label, words, width in given:
        first = prefix(words, order, threshold)
        hot |= set(first)
        each.append(
            F.struct(
                F.lit(label).alias("label"), strings(sorted(words, key=rank.__getitem__)).alias("tokens"),
                strings(first).alias("prefix"), F.lit(needed(len(words), threshold)).alias("need"),
                F.lit(width).alias("width"),
            )
        )
    kind = "array<struct<label: string, tokens: array<string>, prefix: array<string>, need: int, width: int>>"
    each = F.array(*each).cast(kind)
    words = F.split(spaced_words(F.col(text)), " ")

    def met(held: Column) -> Column:
        enough = lambda t: F.size(F.array_intersect(t["tokens"], held)) >= t["need"]
        return F.filter(each, lambda t: F.arrays_overlap(t["prefix"], held) & enough(t))

    rows = documents.select(*keys, words.alias("words"))
    rows = rows.where(F.arrays_overlap("words", strings(sorted(hot))))
    rows = rows.select(*keys, "words", let(F.array_intersect("words", strings(vocabulary)), met).alias("met"))
    rows = rows.select(*keys, "words", F.explode("met").alias("t"))
    # Places of the template's words: word number, and rank in the template, rarest first.
    ranked = F.transform("words", lambda w, i: F.struct(i.alias("i"), F.array_position("t.tokens", w).cast("int").alias("r")))
    need, width = F.col("t.need"), F.col("t.width")

    def most(places: Column) -> Column:
        reaches = lambda p, k: F.get(places, k + need - 1)["i"] < p["i"] + width
        starts = F.transform(places, lambda p, k: F.when(reaches(p, k), F.struct(k.alias("k"), p["i"].alias("i"))))

        def shared(s: Column) -> Column:
            near = F.filter(F.slice(places, s["k"] + 1, width), lambda p: p["i"] < s["i"] + width)
            ranks = F.transform(near, lambda p: p["r"])
            return let(ranks, lambda r: F.when(F.size("t.tokens") - F.array_min(r) + 1 >= need, F.size(F.array_distinct(r))))

        return F.array_max(F.transform(F.array_compact(starts), shared))

    rows = rows.select(*keys, "t", let(F.filter(ranked, lambda p: p["r"] > 0), most).alias("shared"))
    found = rows.where(F.col("shared") >= F.col("t.need"))
    return found.select(*keys, F.col("t.label").alias("label"), (F.col("shared") / F.size("t.tokens")).alias("containment"))


def prefix(words, order: list[str], threshold: float) -> list[str]:
    rank = {w: i for i, w in enumerate(order)}
    tokens = sorted(words, key=rank.__getitem__)
    return tokens[: len(tokens) - needed(len(tokens), threshold) + 1]


def phrase_places(spaced: Column, phrases=PHRASES) -> Column:
    """Per phrase the word numbers at which it starts; texts without any phrase are not split."""
    def places(words: Column) -> Column:
        def starts(phrase: str) -> Column:
            tokens = phrase.split(" ")

            def here(i: Column) -> Column:
                hit = F.get(words, i) == tokens[0]
                for k, token in enumerate(tokens[1:], 1):
                    hit = hit & F.coalesce(F.get(words, i + k) == token, F.lit(False))
                return hit

            return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)

        return F.array(*(starts(p) for p, _ in phrases))

    held = F.lit(False)
    for phrase, _ in phrases:
        held = held | F.contains(spaced, F.lit(phrase))
    none = F.array(*(F.array().cast("array<int>") for _ in phrases))
    return F.when(held, let(F.split(spaced, " "), places)).otherwise(none)


def scan_documents(
    documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, max_templates: int = MAX_TEMPLATES
) -> DataFrame:
    """Per document the places of base phrases and the labels of phrases, blocks and windows of words.

    Every text is cleaned and split once, into the template words that it holds; the text goes on only where these could
    reach ``threshold`` of some template (blocks and windows hold no more). Null text counts as empty. Results of blocks
    come back by id and a digest of the text, so rows that share an id (or have none) keep their own labels and
    repeated rows stay repeated.
    """
    spark = documents.sparkSession
    key = ["__id", "__text"]
    parted = template_words(templates, max_templates)
    vocabulary = sorted(set().union(*(w for _, w in parted))) if parted else []
    base = documents.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.xxhash64("text").alias("__text"),
        spaced_words(F.col("text")).alias("spaced"),
    )
    counted = F.when(F.col("spaced") == "", 0).otherwise(
        F.length("spaced") - F.length(F.replace(F.col("spaced"), F.lit(" "), F.lit(""))) + 1
    )
    base = base.select(
        "doc_id", *key, "text", counted.cast("long").alias("n_words"), phrase_places(F.col("spaced")).alias("places"),
        F.array_intersect(F.split("spaced", " "), strings(vocabulary)).alias("held"),
    )
    each = F.array(
        *(
            F.struct(strings(sorted(w)).alias("tokens"), F.lit(needed(len(w), threshold)).alias("need"))
            for _, w in parted
        )
    ).cast("array<struct<tokens: array<string>, need: int>>")
    could = F.exists(each, lambda t: F.size(F.array_intersect(t["tokens"], F.col("held"))) >= t["need"])
    base = staged(spark, base.withColumn("text", F.when(could, F.col("text"))), "template-words")
    order = rarest_first(base, vocabulary)
    could_match = base.where("text IS NOT NULL").select(*key, "text")
    found = matching_blocks(could_match, templates, threshold, keys=key, order=order, max_templates=max_templates)
    # Blocks are three physical lines; windows of words find notices that more lines hold.
    found = found.select(*key, "label", "containment").unionByName(
        matching_windows(could_match, templates, threshold, key, order=order, max_templates=max_templates)
    )
    found = found.groupBy(*key).agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment")
    )
    labels = F.array_compact(
        F.array(*(F.when(F.size(F.get("places", F.lit(i))) > 0, label) for i, (_, label) in enumerate(PHRASES)))
    )
    spaced = base.drop("text", "held").withColumn("starts", F.flatten("places"))
    spaced = spaced.withColumn("base", F.array_sort(F.array_distinct(labels)))
    joined = spaced.join(found, key, "left")
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union("base", F.coalesce("found", none)))
    return joined.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
