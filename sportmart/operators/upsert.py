"""Keyed upsert for targets without a transactional MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sportmart.operators.sets import has_whole_key, latest_per_key


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        df.where(has_whole_key(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def single_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Source rows with the latest row of every whole key; rows with a null key part all stay."""
    return latest_per_key(source, keys, order)


DUPLICATES = ("error", "latest", "any", "unique")


def _checked(on_duplicate: str, order: Sequence[str]) -> None:
    if on_duplicate not in DUPLICATES:
        raise ValueError(f"on_duplicate must be one of {', '.join(DUPLICATES)}, not {on_duplicate!r}")
    if on_duplicate == "latest" and not order:
        raise ValueError("the latest row needs an order; 'any' takes the row with the greatest columns")


def _single(condition: Column, keys: Sequence[str]) -> Column:
    """A filter that fails the job where a key has several source rows; column pruning cannot remove it."""
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys)))
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """Target after "update when matched, insert when not", with ``_inserted`` and ``_updated`` per row.

    Both sides are read once and meet by key. Keys compare column by column, so a null
    key part never matches; null-keyed rows get a number of their own beside
    the key and do not meet in one task. Several source rows of one key
    fail the running job (``error``), or the one with the greatest ``order``
    counts (``latest``, ties to the greatest remaining columns), or the one with the greatest columns
    (``any``), or the caller knows that there are none (``unique``). Those of ``latest`` and ``any`` fold before they
    are shuffled. Where all columns are keys, nothing can change and both sides fold to one row per key and task.
    """
    _checked(on_duplicate, order)
    columns = target.columns
    changed = [name for name in (columns if update_cols is None else update_cols) if name not in keys]
    order = [name for name in order if name not in keys] if on_duplicate == "latest" else []
    rest = [name for name in columns if name not in keys and name not in order]
    whole = has_whole_key(keys)
    apart = f"IF({whole}, NULL, monotonically_increasing_id()) AS _apart"
    group = [*keys, "_apart"]
    # numbers of the two sides differ in sign, so that null-keyed rows meet nothing
    incoming = source.selectExpr(*[f"`{name}`" for name in dict.fromkeys([*columns, *order])], apart)
    incoming = incoming.withColumn("_apart", -1 - F.col("_apart"))
    stored = target.selectExpr(*[f"`{name}`" for name in columns], apart, "false AS _source")
    if not rest and not order:
        return _merged_keys(stored, incoming, columns, group, on_duplicate)
    new = F.struct(F.lit(1).alias("_one"), *order, *rest)
    if on_duplicate in ("latest", "any"):
        incoming = incoming.groupBy(*group).agg(F.max(new).alias("_new"))
        incoming = incoming.select(*keys, "_new.*", "_apart", "_new")
    else:
        incoming = incoming.withColumn("_new", new)
    incoming = incoming.select(*columns, "_apart", F.lit(True).alias("_source"), "_new")
    both = stored.withColumn("_new", F.lit(None).cast(incoming.schema["_new"].dataType)).union(incoming)
    every = Window.partitionBy(*group)
    # target rows first
    ranked = every.orderBy("_source")
    seen = both.select(
        "*",
        F.row_number().over(ranked).alias("_rank"),
        F.count("_new").over(every).alias("_n"),
        F.first("_new", ignorenulls=True).over(
            ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("_best"),
    )
    if on_duplicate == "error":
        seen = seen.where(_single(F.col("_n") < 2, keys))
    kept = seen.where("NOT _source OR _rank = 1")
    values = [
        f"IF(_source OR _best IS NULL, `{name}`, _best.`{name}`) AS `{name}`" if name in changed else f"`{name}`"
        for name in columns
    ]
    return kept.selectExpr(*values, "_source AS _inserted", "NOT _source AND _best IS NOT NULL AS _updated")


def _merged_keys(
    stored: DataFrame, incoming: DataFrame, columns: Sequence[str], group: Sequence[str], on_duplicate: str
) -> DataFrame:
    """``merged`` where all columns are keys: the rows of a key are counted, those of the target stay as often as they stood there."""
    both = stored.union(incoming.select(*columns, "_apart", F.lit(True).alias("_source")))
    folded = both.groupBy(*group).agg(
        F.count_if(~F.col("_source")).alias("_there"), F.count_if("_source").alias("_come")
    )
    if on_duplicate == "error":
        folded = folded.where(_single(F.col("_come") < 2, columns))
    again = F.explode(F.expr("sequence(1L, greatest(_there, 1L))")).alias("_again")
    return folded.select(
        *columns, (F.col("_there") == 0).alias("_inserted"), ((F.col("_there") > 0) & (F.col("_come") > 0)).alias("_updated"),
        again,
    ).drop("_again")


def merged_by_bucket(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """``merged`` for a target stored in buckets of ``keys``: the source folds to one row per key and joins the buckets, which are
    not shuffled if there are as many shuffle partitions as buckets. Source rows with a null key part join nothing and
    are not shuffled either."""
    _checked(on_duplicate, order)
    columns = target.columns
    changed = [name for name in (columns if update_cols is None else update_cols) if name not in keys]
    order = [name for name in order if name not in keys] if on_duplicate == "latest" else []
    rest = [name for name in columns if name not in keys and name not in order]
    whole = has_whole_key(keys)
    new = F.struct(F.lit(1).alias("_one"), *order, *rest)
    come = source.where(whole).groupBy(*keys).agg(F.max(new).alias("_new"), F.count(F.lit(1)).alias("_n"))
    if on_duplicate == "error":
        come = come.where(_single(F.col("_n") < 2, keys))
    there = target.select(*columns, F.lit(True).alias("_there"))
    both = there.join(come.select(*keys, "_new"), list(keys), "full_outer")
    values = [
        f"`{name}`" if name in keys
        else f"IF(_there IS NULL, _new.`{name}`, `{name}`) AS `{name}`" if name not in changed
        else f"IF(_new IS NULL, `{name}`, _new.`{name}`) AS `{name}`"
        for name in columns
    ]
    rows = both.selectExpr(*values, "_there IS NULL AS _inserted", "_there IS NOT NULL AND _new IS NOT NULL AS _updated")
    apart = source.where(f"NOT ({whole})").select(*columns, F.lit(True).alias("_inserted"), F.lit(False).alias("_updated"))
    return rows.union(apart)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """Target after "update when matched, insert when not"; nothing is deleted.

    ``update_cols`` defaults to every non-key column. Columns not listed keep
    their target value. ``order`` decides between copies under "latest".
    """
    return merged(target, source, keys, update_cols, on_duplicate, order).drop("_inserted", "_updated")


def upsert_counts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> DataFrame:
    """One row (rows_inserted, rows_updated) of the same upsert."""
    return merged(target, source, keys, [], on_duplicate, order).selectExpr(
        "count_if(_inserted) AS rows_inserted", "count_if(_updated) AS rows_updated"
    )


def merge_into(source: DataFrame, table: str, keys: Sequence[str], update_cols: Sequence[str]) -> None:
    """The same upsert as a MERGE, for catalogs whose tables support it."""
    view = source.alias("src")
    condition = reduce(
        lambda a, b: a & b, [F.expr(f"{table}.`{key}` = src.`{key}`") for key in keys]
    )
    writer = view.mergeInto(table, condition)
    changed = {name: F.col(f"src.`{name}`") for name in update_cols if name not in keys}
    if changed:
        writer = writer.whenMatched().update(changed)
    writer.whenNotMatched().insertAll().merge()
