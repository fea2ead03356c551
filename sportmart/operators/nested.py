"""Arrays, structs and maps to rows and back.

Everything here but ``collect_flatten`` works row by row: no shuffle, and the
size of a group of rows does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_path(df: DataFrame, path: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the array at ``path``; null and empty arrays give none."""
    return df.select(*keep, F.explode(path).alias(alias))


def explode_chain(df: DataFrame, steps: Sequence[tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Explode arrays nested in arrays: ``[("stats", "s"), ("s.owner.grounds", "g")]``.

    Every alias of an earlier step stays available to the later ones and in
    the result.
    """
    kept = list(keep)
    for position, (path, alias) in enumerate(steps):
        later = {after.split(".")[0] for after, _ in steps[position + 1 :]}
        inner = [name for name in df.columns if name not in kept and name in later]
        df = df.select(*kept, *inner, F.explode(path).alias(alias))
        kept.append(alias)
    return df.select(*kept)


def array_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.ArrayType)]


def stack_array_columns(
    df: DataFrame,
    columns: Sequence[str],
    value: str,
    label: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Array columns with one element type to rows, one row per element.

    Unpivot is generated code over one read of the input, whatever the number
    of columns. ``label`` names a column for the origin.
    """
    lists = df.unpivot(list(keep), list(columns), label or "_label", "_list").where("_list IS NOT NULL")
    extra = [label] if label else []
    return lists.select(*keep, *extra, F.explode("_list").alias(value))


def map_to_rows(df: DataFrame, column: str, key: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """An object with data as keys (a map column) to one row per entry."""
    return df.select(*keep, F.explode(column).alias(key, value))


def map_items_to_rows(
    df: DataFrame, column: str, items: str, key: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """``{key: {items: [value, ...]}}`` to rows (key, value)."""
    entries = map_to_rows(df, column, key, "_entry", keep)
    return entries.select(*keep, key, F.explode(F.col("_entry")[items]).alias(value))


def star(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Fields of a struct column as top-level columns."""
    return df.select(*keep, f"{column}.*")


def flatten_arrays(df: DataFrame, column: str, alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """Array of arrays to rows of the inner elements."""
    return df.select(*keep, F.explode(F.flatten(column)).alias(alias))


def collect_flatten(
    df: DataFrame, keys: Sequence[str], array: str, part: Column, part_name: str = "part"
) -> DataFrame:
    """Join the arrays of one key into longer arrays, in bounded parts.

    ``part`` splits a key into pieces that each fit in a row, for instance a
    unique id divided by a piece size. A key with any number of rows is then
    spread over many groups. Order inside a piece is not defined.
    """
    return (
        df.groupBy(*keys, part.alias(part_name))
        .agg(F.flatten(F.collect_list(array)).alias(array))
    )


def variant_rows(df: DataFrame, column: str, levels: int, keep: Sequence[str] = ()) -> DataFrame:
    """Values below a VARIANT to rows (path, type, text), whatever keys and types there are.

    ``levels`` is how deep objects and lists are opened; what lies deeper stays JSON text, as do empty objects and lists. Path
    steps are ``.key`` and ``[position]``. A null document gives no row. All levels are opened in one pass over the rows.
    """
    rows = df.where(F.col(column).isNotNull()).select(*keep, F.lit("").alias("path"), F.col(column).alias("_value"))
    spark = df.sparkSession
    for _ in range(levels):
        parts = spark.tvf.variant_explode_outer(F.col("_value").outer()).toDF("_at", "_key", "_part")
        step = F.when(F.col("_key").isNotNull(), F.concat(F.lit("."), "_key")).otherwise(
            F.concat(F.lit("["), F.col("_at").cast("string"), F.lit("]"))
        )
        rows = rows.lateralJoin(parts).select(
            *keep, F.concat("path", F.coalesce(F.when(F.col("_at").isNotNull(), step), F.lit(""))).alias("path"),
            F.coalesce("_part", "_value").alias("_value"),
        )
    return rows.select(
        *keep, "path", F.schema_of_variant("_value").alias("type"), F.try_variant_get("_value", "$", "string").alias("text")
    )
