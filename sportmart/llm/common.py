"""What the operators of this package share: words, bindings, staged tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.session import shared_dir

#: Separators of words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows without an id sort behind every other row and count as one document.
NO_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A name bound by a lambda is a slot; a column expression that is read inside
    another lambda would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_words(text: Column) -> Column:
    """Runs of characters other than ``BLANKS``; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \x09-\x0D]+"))


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def staged(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that several branches read it and a lost
    executor costs no recomputation. The files stay until ``session.remove_shared``."""
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Documents are long rows: so many of them, and about so many bytes, go to a Python worker at a time.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package also when the driver found it through ``sys.path`` alone, and keep the
    batches that they get small (a smaller number of rows, and any bound of bytes that the session sets, stay)."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, BATCH_ROWS)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if size not in spark.conf.getAll:
        spark.conf.set(size, BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
