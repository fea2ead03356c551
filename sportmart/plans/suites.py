"""Which checks hold for which source and table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sportmart.operators.quality import Suite
from sportmart.schemas import Columns

# fixed values: mandatory columns of the sources
MANDATORY = {
    "seasons": ["id", "label"],
    "club_info": ["id", "name", "club", "grounds"],
    "club_stats": ["entity", "stats"],
    "player_info": ["playerId", "info", "nationalTeam", "name", "birth"],
    "player_stats": ["entity", "stats"],
    "manager_info": ["officialId", "birth", "currentTeam"],
    "season_award": ["awardTypeId", "award", "player", "apiTeam", "official"],
    "match_info": ["id", "teams", "kickoff", "attendance", "clock", "ground"],
}

# fixed values: columns of the sources that hold no null; None means all
NOT_NULL: dict[str, list[str] | None] = {
    "club_info": ["grounds"],
    "club_stats": ["stats"],
    "month_award": None,
}


def raw_suite(name: str, df: DataFrame) -> Suite:
    """Mandatory columns and nulls of a source; meant to warn."""
    suite = Suite(name, df).columns_exist(MANDATORY.get(name, []))
    if name in NOT_NULL:
        wanted = NOT_NULL[name]
        suite.not_null([c for c in df.columns if c != "season"] if wanted is None else wanted)
    return suite


def table_suite(name: str, df: DataFrame, columns: Columns, strict: bool = False) -> Suite:
    """Column set and types of a built table; meant to raise."""
    return Suite(name, df).column_set([column for column, _ in columns]).column_types(columns, strict)
