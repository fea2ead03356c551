"""Writing: landing zone, bronze, and tables of the session's catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sportmart.operators.upsert import merged, merged_by_bucket
from sportmart.session import settings, shared_dir, staged
from sportmart.sources.frames import empty_frame

#: Partition values that one upsert may touch. Their list is broadcast, to prune the target's partitions.
MAX_PARTITIONS = 10_000


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a partition value together, in several tasks where there are many.

    The hint lets adaptive execution merge small values into one task and
    split a value that holds much of the data.
    """
    return df.hint("rebalance", *columns)


#: Lines of a landed file at most. A gzip file is read by one task, so none may grow with the source.
LINES_PER_FILE = 50_000

#: Shuffle files go when the job that wrote them ends, not when the driver collects garbage. What is read may be landed pages, whose
#: rows are about ten times as large as their files: a listing is not broadcast by the size of its files.
LANDING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "10",
}


def write_lines(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """JSON Lines as gzip files of bounded length: names and nesting repeat on every line, so plain text is many times larger."""
    writer = df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
    with settings(df.sparkSession, LANDING):
        writer.partitionBy(*partition_by).json(path)


def land_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines by season, in files that many tasks share on read, unlike one array per file."""
    write_lines(balanced(df, "season"), path, ["season"], mode)


def land_sources(sources: dict[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """Every source frame as JSON Lines, by season where it has one."""
    for name, df in sources.items():
        path = f"{root.rstrip('/')}/{name}"
        if "season" in df.columns:
            land_json(df, path, mode)
        else:
            write_lines(df, path, mode=mode)


def land_documents(df: DataFrame, root: str, path: str, seasons: Sequence[str], per_file: int = 1000) -> None:
    """Documents as multi-line JSON arrays below ``path``, whose ``{season}`` names their season.

    The layout in which documents arrive. A season is a directory of files
    of about ``per_file`` documents, so no task gathers a whole season.
    """
    document = F.to_json(F.struct(*[name for name in df.columns if name != "season"]))
    rows = df.select("season", document.alias("document"))
    for season in seasons:
        own = rows.where(F.col("season") == season)
        pieces = -(-own.count() // per_file) or 1
        piece = F.pmod(F.xxhash64("document"), F.lit(pieces))
        arrays = own.groupBy(piece).agg(F.array_join(F.collect_list("document"), ",\n").alias("items"))
        text = arrays.select(F.concat(F.lit("[\n"), "items", F.lit("\n]")).alias("value"))
        text.write.option("maxRecordsPerFile", 1).text(f"{root.rstrip('/')}/{path.replace('{season}', season)}")


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    if partition_by:
        balanced(df, *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def to_bronze(
    sources: dict[str, DataFrame], root: str, mode: str = "overwrite", by_file: bool = False
) -> dict[str, DataFrame]:
    """Parse every source once into Parquet by season and read it back.

    Later reads are split, pruned by season and by nested column; JSON is
    none of these. ``by_file`` says that each input file is of one season, as
    JSON arrays are: a task then holds one season already and nothing shuffles.
    """
    bronze = {}
    for name, df in sources.items():
        path = f"{root.rstrip('/')}/{name}"
        if by_file and "season" in df.columns:
            df.write.mode(mode).partitionBy("season").parquet(path)
        else:
            write_parquet(df, path, ["season"] if "season" in df.columns else [], mode)
        spark = df.sparkSession
        bronze[name] = spark.read.schema(_partition_last(df.schema)).parquet(path)
    return bronze


def _partition_last(schema: T.StructType) -> T.StructType:
    fields = [column for column in schema if column.name != "season"]
    return T.StructType(fields + [column for column in schema if column.name == "season"])


def target_schema(spark: SparkSession, table: str) -> T.StructType:
    """Schema of a table by name or of a Parquet path; reads no rows."""
    if "/" in table:
        return spark.read.parquet(table).schema
    return spark.table(table).schema


def empty_like(spark: SparkSession, table: str) -> DataFrame:
    return empty_frame(spark, target_schema(spark, table))


class Counts(NamedTuple):
    rows_inserted: int
    rows_updated: int


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    return spark.table(table).schema


def schema_difference(stored: T.StructType, rows: T.StructType) -> str:
    """What tells two schemas apart, by column name and type; empty if nothing does."""
    have = {column.name: column.dataType.simpleString() for column in stored}
    come = {column.name: column.dataType.simpleString() for column in rows}
    names = sorted(n for n in {*have, *come} if have.get(n) != come.get(n))
    return "; ".join(f"{n}: {have.get(n, 'absent')} stored, {come.get(n, 'absent')} given" for n in names)


def layout_of(spark: SparkSession, table: str) -> tuple[str | None, int]:
    """Partition column of a table, if any, and its number of buckets, 0 if it has none."""
    columns = spark.catalog.listColumns(table)
    partition = next((column.name for column in columns if column.isPartition), None)
    if not any(column.isBucket for column in columns):
        return partition, 0
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return partition, int(facts["Num Buckets"])


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: str | None = None,
    buckets: int = 0, keys: Sequence[str] = (),
) -> None:
    """A table without rows in the catalogue, which keeps its schema, partitioning and buckets (sorted by ``keys``)."""
    writer = empty_frame(spark, schema).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table)


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what the job that writes it will have counted: no job of its own.

    Put it behind the last shuffle: rows of a task that ran twice before a shuffle would count twice.
    """
    seen = Observation()
    return df.observe(seen, *(value.alias(name) for name, value in counts.items())), seen


def observed_nulls(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``observed`` with ``element_count`` and the nulls of every column, ``null_<position>``."""
    nulls = {f"null_{i}": F.count_if(F.col(f"`{name}`").isNull()) for i, name in enumerate(df.columns)}
    return observed(df, element_count=F.count(F.lit(1)), **nulls)


def _stored_as_partition(df: DataFrame, column: str) -> DataFrame:
    """An empty text as partition value would be read back as null, so it fails the job."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df
    message = F.raise_error(F.lit(f"an empty {column} cannot be a partition value"))
    return df.withColumn(column, F.when(F.col(column) == "", message.cast("string")).otherwise(F.col(column)))


def touched_rows(table: DataFrame, source: DataFrame, column: str, with_null: bool) -> DataFrame:
    """Rows of the target's partitions that the source has values of.

    The semi-join on the partition column becomes a partition filter when the values are known, so other partitions'
    files are not opened. Null equals nothing in it: the null partition is read if the source has null.
    """
    values = source.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0").select(column)
    rows = table.join(F.broadcast(values), column, "left_semi").select(*table.columns)
    return rows.union(table.where(F.col(column).isNull())) if with_null else rows


def upsert_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    update_cols: Sequence[str],
    partition_by: str | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
    buckets: int = 0,
) -> Counts:
    """Upsert into a table of the session's catalogue, which is made first if it is not there.

    The result is written to the shared folder and from there over the table, since Spark overwrites nothing that it reads in the
    same job. A table partitioned by one of its keys can only match inside a partition: only partitions that the source has
    values for are read and replaced. A table in ``buckets`` of its keys is not shuffled, only the source is. Numbers of
    inserted and updated rows come from the job that writes the result. If replacing fails, the error names the folder
    that holds the result. Rows with a null key part are inserted every time.
    """
    spark = source.sparkSession
    if partition_by is not None and partition_by not in keys:
        raise ValueError("a partitioned table needs its partition column among the keys")
    if on_duplicate == "latest" and not order:
        raise ValueError("the latest row needs an order; 'any' takes the row with the greatest columns")
    if not spark.catalog.tableExists(table):
        create_table(spark, table, source.schema, partition_by, buckets, keys)
    # Another session may have replaced files that this one has listed.
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    difference = schema_difference(target.schema, source.schema)
    if difference:
        raise ValueError(f"columns of {table} differ: {difference}")
    column, n_buckets = layout_of(spark, table)
    if n_buckets:
        return _replace(
            merged_by_bucket(target, source, keys, update_cols, on_duplicate, order), table, buckets=n_buckets, keys=keys
        )
    if column is None:
        return _replace(merged(target, source, keys, update_cols, on_duplicate, order), table)
    incoming, seen = observed(
        _stored_as_partition(source.select(*target.columns), column),
        values=F.approx_count_distinct(column), nulls=F.count_if(F.col(column).isNull()),
    )
    incoming = staged(incoming, "source")
    if seen.get["values"] > MAX_PARTITIONS:
        raise ValueError(f"{table}: an upsert touches about {seen.get['values']} partitions of at most {MAX_PARTITIONS}")
    before = touched_rows(target, incoming, column, seen.get["nulls"] > 0)
    return _replace(merged(before, incoming, keys, update_cols, on_duplicate, order), table, column)


def _replace(
    rows: DataFrame, table: str, column: str | None = None, buckets: int = 0, keys: Sequence[str] = ()
) -> Counts:
    """Rows of ``merged`` over the table, or over those of its partitions that they have values of."""
    spark = rows.sparkSession
    columns = spark.table(table).columns
    if column:
        rows = balanced(rows, column)
    rows, seen = observed(
        rows, rows_inserted=F.count_if(F.col("_inserted")), rows_updated=F.count_if(F.col("_updated"))
    )
    result, draft = rows.select(*columns), None
    # As many partitions as buckets, so that a folded source meets them without another shuffle.
    scope = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if column else "static"}
    if buckets:
        scope |= {"spark.sql.shuffle.partitions": buckets, "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    with settings(spark, scope):
        if buckets:
            draft = f"{table}_draft"
            spark.sql(f"DROP TABLE IF EXISTS {draft}")
            result.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(draft)
            ready, place = spark.table(draft), draft
        else:
            place = shared_dir(spark, "result")
            writer = result.write.partitionBy(column) if column else result.write
            writer.parquet(place)
            ready = spark.read.schema(result.schema).parquet(place).select(*columns)
        try:
            ready.write.mode("overwrite").insertInto(table)
        except Exception as error:
            error.add_note(f"the rows of {table} are in {place}")
            raise
    if draft:
        spark.sql(f"DROP TABLE {draft}")
    return Counts(int(seen.get["rows_inserted"]), int(seen.get["rows_updated"]))


def write_sorted(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """A new table sorted by its business key over all files, so that a read of a key range skips files and row groups.

    A sample of the rows sets the ranges. Rows of one key are dealt by a digest too, so a key that holds much of the
    data is split over several tasks and files.
    """
    order = [*(F.col(key) for key in keys), F.xxhash64(*df.columns)]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.saveAsTable(table)
