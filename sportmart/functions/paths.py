"""Nested paths: existence, typed access, positional access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def path_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a dotted path through structs, or None if there is no such path."""
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def path_or_null(df: DataFrame, path: str, dtype: str) -> Column:
    """The field at ``path`` cast to ``dtype``, or a typed null when absent."""
    if path_type(df.schema, path) is None:
        return F.lit(None).cast(dtype)
    return F.col(path).cast(dtype)


def nth(array: str | Column, position: int, path: str = "") -> Column:
    """Field at ``path`` of the element at a 0-based position; null beyond the end."""
    value = F.get(F.col(array) if isinstance(array, str) else array, F.lit(position))
    for part in filter(None, path.split(".")):
        value = value[part]
    return value
