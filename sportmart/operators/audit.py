"""Load audit, freshness, lineage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.sources.frames import literal, literal_rows

AUDIT_DDL = "table STRING, operation STRING, ts TIMESTAMP_NTZ, rows_inserted BIGINT, rows_updated BIGINT"



def audit_row(counts: DataFrame, table: str, ts: datetime, operation: str = "UPDATE") -> DataFrame:
    """A row of the audit table from the counts of an upsert."""
    return counts.select(
        F.lit(table).alias("table"), F.lit(operation).alias("operation"),
        literal(ts, "timestamp_ntz").alias("ts"), "rows_inserted", "rows_updated",
    )


def freshness(
    audit: DataFrame, tables: Sequence[str], now: datetime, max_age: timedelta = timedelta(hours=1)
) -> DataFrame:
    """(table, last_ts, fresh) for every listed table, also those never loaded.

    The aggregate leaves one row per table before the listed names join in.
    """
    ts_type = audit.schema["ts"].dataType.simpleString()
    last = audit.where(F.col("table").isin(list(tables))).groupBy("table").agg(F.max("ts").alias("last_ts"))
    wanted = literal_rows(audit.sparkSession, [(name,) for name in tables], "table STRING")
    oldest = literal(now - max_age, ts_type)
    return wanted.join(last, "table", "left").select(
        "table", "last_ts", F.coalesce(F.col("last_ts") >= oldest, F.lit(False)).alias("fresh")
    )


def lineage(spark: SparkSession, inputs: dict[str, Sequence[str]]) -> DataFrame:
    """Mapping rows (source, table) from table -> sources."""
    pairs = [(source, table) for table, sources in inputs.items() for source in sources]
    return literal_rows(spark, pairs, "source STRING, table STRING")
