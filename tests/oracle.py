"""Run a catalogue query and its SQL and compare the rows as bags."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    """One form per value: integral numbers as int, times without zone."""
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def types_of(columns, rows):
    """Python types of the non-null values per column."""
    return {c: sorted({type(r[i]).__name__ for r in rows if r[i] is not None}) for i, c in enumerate(columns)}


def run_sql(connection, sql):
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()
