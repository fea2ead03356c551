"""Small frames made in the JVM, of a size the optimizer knows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """No rows, all columns."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    typed_nulls = [F.lit(None).cast(column.dataType).alias(column.name) for column in schema]
    return spark.range(1).select(*typed_nulls).limit(0)


def literal(value, dtype: T.DataType | str) -> Column:
    """A typed literal. Zone-free timestamps go as text: a datetime literal
    would pass through the zones of Python and of the session."""
    if isinstance(value, datetime) and dtype in (T.TimestampNTZType(), "timestamp_ntz"):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few rows of literals."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return empty_frame(spark, schema)
    structs = [
        F.struct(*[literal(value, column.dataType).alias(column.name) for value, column in zip(row, schema)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))

