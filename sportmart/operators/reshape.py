"""Long statistics to one column per statistic."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many names become columns in one aggregate. Its rows hold every column, so with more names a pivot is cheaper.
FEW_NAMES = 16

AGGREGATES: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max, "min": F.min}


def distinct_sorted(df: DataFrame, column: str, limit: int) -> list[str]:
    """The distinct non-null values of a column, sorted, for names that become columns.

    They come to the driver, so the caller says how many there may be: more
    than ``limit`` is an error rather than a shorter list.
    """
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values; pass the names")
    return sorted(row[0] for row in rows)


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    names: Sequence[str],
    agg: str = "sum",
    listed_only: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """One row per key, one column per name in ``names``.

    A name without rows for a key gives null, not 0. Names outside the list
    give no column; a key with only such names stays, with nulls, unless
    ``listed_only`` drops those rows before the aggregate. Rows with a null
    key part are dropped, as they match nothing in the joins that follow,
    unless ``null_keys`` keeps them as a group.
    Up to ``FEW_NAMES`` names, rows fold to one per key before the only
    shuffle. With more, they fold to one per key and name before a shuffle and
    to one per key behind it, as a row of all columns would be mostly nulls.
    """
    fold = AGGREGATES[agg]
    if not null_keys:
        df = df.dropna("any", subset=list(keys))
    if listed_only:
        df = df.where(F.col(name).isin(list(names)))
    if not names:
        return df.select(*keys).distinct()
    if len(names) <= FEW_NAMES:
        return df.groupBy(*keys).agg(*[fold(F.when(F.col(name) == each, F.col(value))).alias(each) for each in names])
    return df.groupBy(*keys).pivot(name, list(names)).agg(fold(value))
