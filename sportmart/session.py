"""Session defaults and the folder shared by all executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions and splits skewed ones,
# so the initial number may be generous; it is the only value worth raising
# with the data (about total shuffle bytes / 128 MB).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sportmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only a session without that setting and with a local master (tests) gets
    a folder of this machine; a cluster must name its shared folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="sportmart-")
    _SHARED.append(os.path.join(base, f"sportmart-{purpose}-{uuid.uuid4().hex}"))
    return _SHARED[-1]


_SHARED: list[str] = []
_DATABASES: list[str] = []


def new_database(spark: SparkSession, purpose: str) -> str:
    """A database of its own whose tables lie in the shared folder, for results that are read once."""
    name = f"sportmart_{purpose}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, purpose)}'")
    _DATABASES.append(name)
    return name


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a costly plan that several branches use: they read files that
    outlive executors instead of running the plan again.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Session settings for the jobs that run inside, then those from before."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def remove_shared(spark: SparkSession) -> None:
    """Delete what this process wrote below ``shared_dir``; call it when results that read it are stored."""
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {_DATABASES.pop()} CASCADE")
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _SHARED:
        path = as_path(_SHARED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
