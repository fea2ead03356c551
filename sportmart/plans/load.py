"""The batch: sources -> checks -> tables -> checks -> upserts -> audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from sportmart.operators.audit import AUDIT_DDL
from sportmart.operators.quality import enforce, run_suites
from sportmart.plans import dims, facts
from sportmart.plans.suites import raw_suite, table_suite
from sportmart.schemas import with_statistics
from sportmart.sources.documents import extract
from sportmart.sources.frames import literal_rows
from sportmart.session import shared_dir
from sportmart.sources.tables import table_schema, to_bronze, upsert_table


@dataclass(frozen=True)
class Target:
    """How a table is loaded: 1-based key columns, 0-based first updated column."""

    sources: tuple[str, ...]
    key_positions: tuple[int, ...] = (1,)
    update_from: int = 1
    partition_by: str | None = None

    def keys(self, columns: Sequence[str]) -> list[str]:
        return [columns[position - 1] for position in self.key_positions]

    def update_cols(self, columns: Sequence[str]) -> list[str]:
        return list(columns[self.update_from :])


# Load order is the order of this mapping. The player fact is keyed without
# its club, and a match updates statistics only: the stored club stays.
TARGETS: dict[str, Target] = {
    "dim_season": Target(("seasons",)),
    "dim_country": Target(("manager_info", "player_info")),
    "dim_manager": Target(("manager_info",)),
    "dim_club": Target(("club_info",)),
    "dim_stadium": Target(("club_info",)),
    "dim_position": Target(("player_info",)),
    "dim_player": Target(("player_info",)),
    "dim_award": Target(("month_award", "season_award")),
    "dim_match": Target(("match_info",)),
    "fct_club_stat": Target(("club_stats", "manager_info", "seasons"), (1, 2, 3, 4), 4, "season_id"),
    "fct_player_stat": Target(("player_stats", "seasons"), (1, 3), 3, "season_id"),
    "fct_object_award": Target(("month_award", "season_award", "seasons"), (1, 2, 3), 0, "season_id"),
    "fct_match_stat": Target(("match_stats", "seasons"), (1, 2, 3), 3, "season_id"),
}


def build_tables(
    sources: dict[str, DataFrame],
    club_names: Sequence[str],
    player_names: Sequence[str],
    match_names: Sequence[str],
    latest: bool = False,
) -> dict[str, DataFrame]:
    """All 13 tables, lazily. ``latest`` keeps one dimension row per key."""
    s = sources
    return {
        "dim_season": dims.dim_season(s["seasons"]),
        "dim_country": dims.dim_country(s["manager_info"], s["player_info"], latest),
        "dim_manager": dims.dim_manager(s["manager_info"], latest),
        "dim_club": dims.dim_club(s["club_info"], latest),
        "dim_stadium": dims.dim_stadium(s["club_info"], latest),
        "dim_position": dims.dim_position(s["player_info"], latest),
        "dim_player": dims.dim_player(s["player_info"], latest),
        "dim_award": dims.dim_award(s["month_award"], s["season_award"], latest),
        "dim_match": dims.dim_match(s["match_info"], latest),
        "fct_club_stat": facts.fct_club_stat(s["club_stats"], s["manager_info"], s["seasons"], club_names),
        "fct_player_stat": facts.fct_player_stat(s["player_stats"], s["seasons"], player_names),
        "fct_object_award": facts.fct_object_award(s["month_award"], s["season_award"], s["seasons"]),
        "fct_match_stat": facts.fct_match_stat(s["match_stats"], s["seasons"], match_names),
    }


def table_columns(
    table: str, club_names: Sequence[str], player_names: Sequence[str], match_names: Sequence[str]
) -> list[tuple[str, str]]:
    names = {"fct_club_stat": club_names, "fct_player_stat": player_names, "fct_match_stat": match_names}
    return with_statistics(table, list(names.get(table, [])))


def check_sources(sources: dict[str, DataFrame], on_fail: str = "warn") -> DataFrame:
    results = run_suites([raw_suite(name, df) for name, df in sources.items()])
    enforce(results, on_fail)
    return results


def check_tables(
    tables: dict[str, DataFrame], columns: dict[str, list[tuple[str, str]]], on_fail: str = "raise"
) -> DataFrame:
    """Column sets and types of built tables, from their schemas alone."""
    results = run_suites([table_suite(name, df, columns[name]) for name, df in tables.items()], count_rows=False)
    enforce(results, on_fail)
    return results


def load_tables(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, now: datetime | None = None
) -> DataFrame:
    """Upsert every table of a database in order, each followed by its audit row.

    Tables whose columns are not those of the stored one stop the load before
    any table is changed. Facts with several rows for a key keep the one with
    the greatest columns.
    """
    stamp = now or datetime.now(timezone.utc).replace(tzinfo=None)
    check_stored(spark, tables, database)
    for name, df in tables.items():
        target = TARGETS[name]
        keys, updates = target.keys(df.columns), target.update_cols(df.columns)
        done = upsert_table(df, f"{database}.{name}", keys, updates, target.partition_by, "any")
        report = literal_rows(spark, [(name, "UPDATE", stamp, *done)], AUDIT_DDL)
        report.write.mode("append").saveAsTable(f"{database}.audit")
    return read_audit(spark, database)


def read_audit(spark: SparkSession, database: str) -> DataFrame:
    return spark.table(f"{database}.audit")


def check_stored(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, on_fail: str = "raise"
) -> DataFrame:
    """Names and types of built tables against the stored ones; tables not stored yet are held against their own."""
    suites = []
    for name, df in tables.items():
        stored = spark.catalog.tableExists(f"{database}.{name}")
        schema = table_schema(spark, f"{database}.{name}") if stored else df.schema
        # The catalogue moves a partition column behind the others.
        place = {column: i for i, column in enumerate(df.columns)}
        wanted = [(column.name, column.dataType.simpleString()) for column in schema]
        suites.append(table_suite(name, df, sorted(wanted, key=lambda c: place.get(c[0], len(place))), strict=True))
    results = run_suites(suites, count_rows=False)
    enforce(results, on_fail)
    return results


def run_sources(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    database: str,
    club_names: Sequence[str],
    player_names: Sequence[str],
    match_names: Sequence[str],
    now: datetime | None = None,
    by_file: bool = False,
) -> DataFrame:
    """The whole batch from source frames to the audited tables of a database; ``by_file`` as in ``to_bronze``."""
    sources = to_bronze(sources, shared_dir(spark, "bronze"), by_file=by_file)
    check_sources(sources)
    tables = build_tables(sources, club_names, player_names, match_names, latest=True)
    columns = {name: table_columns(name, club_names, player_names, match_names) for name in tables}
    check_tables(tables, columns)
    return load_tables(spark, tables, database, now)


def run(
    spark: SparkSession,
    landing: str,
    database: str,
    club_names: Sequence[str],
    player_names: Sequence[str],
    match_names: Sequence[str],
    seasons: Sequence[str] | None = None,
    now: datetime | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """The whole batch from landed documents, one JSON file per entity and season.

    Sources named in ``optional`` may be absent. A file is one task here, however
    large; land large sources as JSON Lines and use ``extract_landed`` with ``run_sources``.
    """
    sources = extract(spark, landing, seasons, optional)
    return run_sources(spark, sources, database, club_names, player_names, match_names, now, by_file=True)


__all__ = [
    "TARGETS", "Target", "build_tables", "check_sources", "check_stored", "check_tables", "load_tables", "read_audit",
    "run", "run_sources",
]
