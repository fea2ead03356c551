"""Text scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def initials(text: Column) -> Column:
    """First letters of the words between blanks and slashes:
    "Central Defender/Midfielder" -> "CDM"."""
    return F.array_join(F.transform(F.split(text, "[ /]"), lambda word: F.substring(word, 1, 1)), "")


def last_segment(url: Column) -> Column:
    """Text after the last slash, without any query part."""
    return F.substring_index(F.substring_index(url, "?", 1), "/", -1)


def season_label(label: Column) -> Column:
    """2022/23 -> 2022-23, the form used in paths."""
    return F.replace(label, F.lit("/"), F.lit("-"))


def object_keys(json_text: Column) -> Column:
    """Top-level keys of a JSON object as an array; null for other text."""
    return F.json_object_keys(json_text)
