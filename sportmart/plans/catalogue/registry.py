"""Registry of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sportmart.plans.standins import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    operators: tuple[str, ...]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None):
    """Register a builder under its function name; ``operators`` are survey ids."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql, tuple(operators.split()))
        return build

    return register


def season_sql(day: str) -> str:
    """Academic year of a date, such as 1998-99, in SQL."""
    start = f"(year({day}) - CASE WHEN month({day}) < 9 THEN 1 ELSE 0 END)"
    return f"({start} || '-' || right(CAST({start} + 1 AS VARCHAR), 2))"


def season_start_sql(day: str) -> str:
    return f"CAST(year({day}) - CASE WHEN month({day}) < 9 THEN 1 ELSE 0 END AS BIGINT)"
