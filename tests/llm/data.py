"""Small documents with what large corpora hold: nulls, empties, long texts, copies, shared passages, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = (
    "id", "key", "words", "chunk", "digest", "print", "stratum", "shard", "slot", "row_number", "n_words", "kept",
    "spans", "ids", "first", "gone", "label", "token", "n_lines", "text_hash", "row", "told", "coded", "__told", "__was", "__coded", "__row", "__id", "__text",
)


def prose(seed: int, n: int, start: str = "") -> str:
    r = random.Random(seed)
    syllables = ("the", "an", "on", "er", "ti", "sh", "é", "ou", "re", "ing", "ß", "st")
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)]
    out = start
    for i, w in enumerate(words):
        out += w + ("\n" if i % 9 == 8 else ". " if i % 7 == 6 else " ")
    return out.strip()


def texts() -> dict[int, str | None]:
    """Texts by distinct ids."""
    passage, shared = prose(1, 70), prose(2, 120)
    base = prose(3, 400)
    words = base.split(" ")
    long = "\n".join(prose(100 + i % 40, 60) for i in range(500)) + " " + "x" * 70_000 + " end"
    notice = "Licensed under the Apache License, Version 2.0."
    return {
        5: base, 6: base, 7: " ".join([*words[:100], "changed", *words[101:]]), 8: " ".join(words[:-2]),
        9: None, 10: "", 11: "  \n\t\x0b \r\n", 12: "word", 13: "two words", 14: "a b c", 15: "A B C",
        20: passage, 21: prose(4, 30) + " " + passage + " " + prose(5, 30), 22: passage + "\n" + shared, 23: shared,
        24: shared + " " + passage, 25: prose(6, 3) + "\n" + shared + "\n" + prose(7, 3),
        30: "Der " * 300, 31: "Der " * 300, 32: "Der\n" * 40, 33: "la la la la la " * 9 + "end",
        40: notice + "\n" + prose(8, 40), 41: "x " + notice.upper() + " y under the MIT license, cc-by-nc 4",
        42: "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and"
            "\nassociated documentation files, to deal in the Software without restriction",
        43: "released under the terms of the gnu general public license version 3 licensed",
        50: "#$%& |<> *" * 20, 51: "日本語 のテキスト です。　全角 ▁ <|endoftext|> <s> \U0001f600 é ֋ ՘a",
        52: "\x00\x01 control\x7f chars", 53: "it's we'll  I'd  \n\n  spaces   " + " " * 50 + "x",
        60: long, 61: long[:90_000] + " tail", 62: prose(9, 3000),
    }


def rows() -> list[tuple]:
    langs = ("en", "fr", None)
    return [(i, t, langs[i % 3], f"src{i % 2}", len(t) if t is not None else None) for i, t in texts().items()]


def frame(spark, values=None, clash: bool = True):
    """The rows as a frame; ``clash`` adds columns named like those that operators use or add."""
    df = spark.createDataFrame(rows() if values is None else values, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clash else df


def awkward() -> list[tuple]:
    """Rows without id, with one id twice, and twice the same row."""
    passage = prose(2, 120)
    return [
        (None, passage, "en", "s", 1), (None, passage, None, None, None), (None, None, None, None, None),
        (1, passage, "en", "s", 1), (1, passage, "en", "s", 1), (1, prose(11, 80), "fr", "s", 1),
        (2, passage + " more", "en", "s", 1), (3, prose(11, 80), "fr", "s", None), (4, "", "fr", "s", 0),
    ]
