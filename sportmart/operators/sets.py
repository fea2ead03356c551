"""Unions that align by name and type, and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.schemas import Columns


def align_to(df: DataFrame, columns: Columns) -> DataFrame:
    """Exactly ``columns``, by name, cast to their types; absent ones are null."""
    present = {name.lower(): f"`{name}`" for name in df.columns}
    return df.selectExpr(
        *[f"CAST({present.get(name.lower(), 'NULL')} AS {dtype}) AS `{name}`" for name, dtype in columns]
    )


def union_all(frames: Sequence[DataFrame], columns: Columns) -> DataFrame:
    """Bag union, every frame aligned to the same columns first."""
    return reduce(DataFrame.union, [align_to(df, columns) for df in frames])


def union_fill(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; a column missing from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame], columns: Columns) -> DataFrame:
    """Set union of aligned frames; one shuffle for all of them."""
    return union_all(frames, columns).distinct()


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks.

    Copies on the left shrink before the join, not after it.
    """
    return left.distinct().subtract(right)


def has_whole_key(keys: Sequence[str]) -> str:
    """Condition that no key part is null."""
    return " AND ".join(f"`{key}` IS NOT NULL" for key in keys)


def latest_whole(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``latest_per_key`` for rows whose keys hold no null."""
    order = [name for name in order if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in order]
    if not order and not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values for every key.

    An aggregate over structs rather than a ranked window: copies of a hot
    key shrink to one row per task before the shuffle. Ties fall to the
    greatest remaining columns, so the choice is the same on every run. Rows
    with a null key part have no identity and all stay.
    """
    whole = has_whole_key(keys)
    return latest_whole(df.where(whole), keys, order).union(df.where(f"NOT ({whole})"))
