"""New files in a landing directory, upserted as they arrive.

The batch pipeline reads a whole season again every week; this reads each
file once. A batch that is repeated after a crash gives the table that it would have
given once: rows with a whole key are the same after a second upsert, and rows with a null key part carry the batch that
inserted them, in the same commit, and are not inserted again where it already did.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.operators.sets import has_whole_key
from sportmart.sources.tables import Counts, layout_of, upsert_table

#: Column of a stream's table: the stream and the batch that wrote the row last.
BATCH = "_batch"


def upsert_batch(
    rows: DataFrame,
    table: str,
    batch: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    partition_by: str | None = None,
    on_duplicate: str = "any",
    order: Sequence[str] = (),
) -> Counts:
    """Upsert one batch, however often it comes.

    A partition is replaced as a whole, so it has either all null-keyed rows of a batch or none. Those that
    have any are looked up by the batch's name before the merge, and the batch's null-keyed rows for them are left out.
    """
    spark = rows.sparkSession
    whole = has_whole_key(keys)
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
        stored = spark.table(table).where(f"NOT ({whole})").where(F.col(BATCH) == batch)
        column, _ = layout_of(spark, table)
        again = F.lit(True)
        if column:
            # A batch touches MAX_PARTITIONS partitions at most; hardly ever has it been here before.
            done = [r[0] for r in stored.select(column).distinct().collect()]
            again = F.col(column).isin([value for value in done if value is not None])
            again = F.coalesce(again, F.lit(None in done))
        elif stored.isEmpty():
            again = F.lit(False)
        rows = rows.where(F.expr(whole) | ~again)
    rows = rows.withColumn(BATCH, F.lit(batch))
    return upsert_table(rows, table, keys, [*update_cols, BATCH], partition_by, on_duplicate, order)


def stream_upsert(
    spark: SparkSession,
    landing: str,
    schema: str,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    build: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
    on_duplicate: str = "any",
    order: Sequence[str] = (),
    partition_by: str | None = None,
) -> None:
    """Process the files that landed since the last call, then return.

    ``build`` turns a batch of documents into rows of the table; it must not
    need rows of other batches, so it suits dimensions and per-document facts.
    A table with ``partition_by`` writes only the partitions of the batch again.
    Between batches the later one wins, whatever its order columns say. The table has a column
    ``_batch`` beside those of ``build``: the stream's id, which its checkpoint keeps, and the batch's number.
    """
    files = (
        spark.readStream.schema(schema)
        .format(file_format)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
    )

    def merge(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        stream = json.loads(own.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        upsert_batch(build(batch), table, f"{stream}/{number}", keys, update_cols, partition_by, on_duplicate, order)

    query = (
        files.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one may have listed files that they replaced.
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
