"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sportmart.llm.common import staged

#: Leading hex digits of the row digest that pick a bucket; rows are numbered bucket by bucket.
BUCKET_DIGITS = 3
#: Copies of a row that are numbered together.
RANGE = 10_000
#: Round keys; any six numbers below the modulus do.
ROUND_KEYS = (101_010_101, 577_215_664, 141_421_356, 271_828_182, 314_159_265, 161_803_398)
MODULUS = 2_147_483_647
FACTOR = 48_271


def domain(n: int, tries: int = 4096) -> tuple[int, int]:
    """Sides ``a`` and ``b`` of the smallest grid with ``n`` cells or more whose first side is one of the
    ``tries`` numbers from the square root of ``n`` upwards. A walk leaves the surplus cells after
    at most ``a * b - n`` steps, as it meets each of them once at most."""
    root = max(1, math.isqrt(max(n, 1) - 1) + 1)
    a = min(range(root, root + tries), key=lambda side: (-n % side, side))
    return a, max(1, -(-n // a))


def whole(value: Column, by: int) -> Column:
    """Whole division of longs."""
    return F.call_function("div", value, F.lit(by).cast("long"))


def mix(value: Column, key: Column) -> Column:
    """A round function on numbers below 2**31 that stays within 64 bits."""
    first = (value * FACTOR + key) % MODULUS
    return (first * first + value + key) % MODULUS


def permuted(number: Column, a: int, b: int) -> Column:
    """One pass of the alternating Feistel network over the cells of an ``a`` by ``b`` grid."""
    rounds = F.expr(
        "array("
        + ", ".join(f"struct({k}L AS k, {(a, b)[i % 2]}L AS m)" for i, k in enumerate(ROUND_KEYS))
        + ")"
    )
    start = F.struct(whole(number, b).alias("l"), (number % b).alias("r"))
    end = F.aggregate(
        rounds, start, lambda s, x: F.struct(s["r"].alias("l"), ((s["l"] + mix(s["r"], x["k"])) % x["m"]).alias("r"))
    )
    return F.aggregate(F.array(end), F.lit(0).cast("long"), lambda _, s: s["l"] * b + s["r"])


def shuffled(number: Column, n: int) -> Column:
    """Cycle walking: permute again while the cell is none of the first ``n``."""
    a, b = domain(n)
    first = permuted(number, a, b)
    surplus = a * b - n
    if not surplus:
        return first
    walk = F.sequence(F.lit(1), F.lit(surplus))
    return F.aggregate(walk, first, lambda y, _: F.when(y < n, y).otherwise(permuted(y, a, b)))


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 without gaps, in the order of a digest of all columns, and their count.

    Buckets of the digest are numbered side by side; only the bucket totals (4096 numbers) reach the driver.
    Equal rows are counted before the shuffle and dealt out again behind it, ``RANGE`` copies at a time and these over all
    tasks, so a row that repeats without end makes no bucket, array or task large. A row travels as one
    column, so its columns may have any names but ``row_number``.
    """
    columns = rows.columns
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in columns)))
    packed = rows.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), digest.alias("digest"))
    counted = packed.groupBy("row", "digest").agg(F.count(F.lit(1)).alias("copies"))
    bucket = F.conv(F.substring("digest", 1, BUCKET_DIGITS), 16, 10).cast("int")
    counted = staged(rows.sparkSession, counted.withColumn("bucket", bucket), "rows")
    totals = {r[0]: r[1] for r in counted.groupBy("bucket").agg(F.sum("copies")).collect()}
    starts, n = [], 0
    for i in range(16**BUCKET_DIGITS):
        starts.append(f"{n}L")
        n += totals.get(i, 0)
    order = Window.partitionBy("bucket").orderBy("digest", "row")
    before = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.get(F.expr(f"array({', '.join(starts)})"), F.col("bucket")) + before
    dealt = counted.select("row", first.alias("first"), (first + F.col("copies")).alias("end"))
    ranges = F.sequence("first", F.col("end") - 1, F.lit(RANGE).cast("long"))
    dealt = dealt.select("row", "end", F.explode(ranges).alias("start"))
    dealt = dealt.repartition("start")
    last = F.least(F.col("start") + RANGE, F.col("end")) - 1
    number = F.explode(F.sequence("start", last)).alias("row_number")
    return dealt.select(*(F.col(f"row.`{c}`").alias(c) for c in columns), number), n


def shard_rows(rows: DataFrame, shards: int) -> DataFrame:
    """Every row with ``row_number``, ``shuffled`` (its place after the shuffle), ``shard`` and ``slot``.

    The place follows from the row number and the count alone, shard and slot from the place: row ``y`` of
    the shuffle is slot ``y div shards`` of shard ``y mod shards``, so counts differ by one at most and slots have no gaps.

    Nulls sort and hash like a value of their own. Equal rows get different numbers, but which of them gets
    which cannot be told. No row, empty result. Columns named like the added ones are replaced.
    """
    added = ("row_number", "shuffled", "shard", "slot")
    rows, n = numbered(rows.drop(*added))
    place = shuffled(F.col("row_number"), n) if n else F.col("row_number")
    out = rows.withColumn("shuffled", place)
    return out.withColumns(
        {
            "shard": (F.col("shuffled") % shards).cast("int"),
            "slot": whole(F.col("shuffled"), shards),
        }
    )


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


SHARDS = 24


def documents_sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    rows = documents.select(
        "doc_id", text_size(F.col("text")).alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    )
    return shard_rows(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def feistel_sql(source: str, number: str, a: str, b: str) -> str:
    """Nested queries that give ``y`` for ``number`` of ``source``."""
    sql = f"SELECT *, {number} // {b} AS l0, {number} % {b} AS r0 FROM {source}"
    for i, key in enumerate(ROUND_KEYS):
        side = (a, b)[i % 2]
        sql = f"SELECT *, (r{i} * {FACTOR} + {key}) % {MODULUS} AS f{i} FROM ({sql})"
        sql = f"SELECT *, r{i} AS l{i + 1}, (l{i} + (f{i} * f{i} + r{i} + {key}) % {MODULUS}) % {side} AS r{i + 1} FROM ({sql})"
    n = len(ROUND_KEYS)
    keep = ", ".join(f"l{i}, r{i}" for i in range(n + 1)) + ", " + ", ".join(f"f{i}" for i in range(n))
    return f"SELECT * EXCLUDE ({keep}), l{n} * {b} + r{n} AS y FROM ({sql})"
