"""Declared schemas: source documents as DDL, target tables as column lists.

Identifiers arrive as JSON doubles, so sources declare DOUBLE and every model
casts to BIGINT at once. Declared schemas make an empty file a 0-row frame
with all columns, and an absent nested field a null.
"""

from __future__ import annotations

from dataclasses import dataclass

RELATED = "relatedContent ARRAY<STRUCT<type: STRING, reference: STRING>>"

AWARD_ITEM = (
    "STRUCT<awardTypeId: DOUBLE, award: STRING, player: STRUCT<playerId: DOUBLE>, "
    "official: STRUCT<officialId: DOUBLE>, apiTeam: STRUCT<id: DOUBLE>, "
    "relatedContent: ARRAY<STRUCT<type: STRING, reference: STRING>>>"
)

MATCH_STAT_ITEMS = "STRUCT<M: ARRAY<STRUCT<name: STRING, value: DOUBLE, description: STRING>>>"


@dataclass(frozen=True)
class Source:
    """Where an entity lands (``{season}`` is a path part) and its shape."""

    path: str
    ddl: str
    # a top-level object with data as keys is read as one map column
    map_column: str | None = None
    # names inside the documents are ids: nearly every document has new ones
    many_names: bool = False


SOURCES: dict[str, Source] = {
    "seasons": Source("season/seasons.json", "id BIGINT, label STRING"),
    "club_info": Source(
        "club/{season}/club_info.json",
        "id DOUBLE, name STRING, club STRUCT<name: STRING, shortName: STRING, abbr: STRING>, "
        "grounds ARRAY<STRUCT<id: DOUBLE, name: STRING, capacity: DOUBLE, city: STRING, "
        "location: STRUCT<latitude: DOUBLE, longitude: DOUBLE>>>",
    ),
    "club_stats": Source(
        "club/{season}/club_stats.json",
        "entity STRING, stats ARRAY<STRUCT<name: STRING, value: DOUBLE, "
        "owner: STRUCT<club: STRUCT<id: DOUBLE>, grounds: ARRAY<STRUCT<id: DOUBLE>>>>>",
    ),
    "player_info": Source(
        "player/{season}/player_info.json",
        "playerId DOUBLE, info STRUCT<position: STRING, shirtNum: DOUBLE, positionInfo: STRING>, "
        "nationalTeam STRUCT<isoCode: STRING, country: STRING, demonym: STRING>, "
        "name STRUCT<first: STRING, last: STRING>, birth STRUCT<date: STRUCT<label: STRING>>",
    ),
    "player_stats": Source(
        "player/{season}/player_stats.json",
        "entity STRING, stats ARRAY<STRUCT<name: STRING, value: DOUBLE, "
        "owner: STRUCT<playerId: DOUBLE, currentTeam: STRUCT<club: STRUCT<id: DOUBLE>>>>>",
    ),
    "manager_info": Source(
        "manager/{season}/manager_info.json",
        "officialId DOUBLE, name STRUCT<first: STRING, last: STRING>, currentTeam STRUCT<id: DOUBLE>, "
        "birth STRUCT<date: STRUCT<label: STRING>, "
        "country: STRUCT<isoCode: STRING, country: STRING, demonym: STRING>>",
    ),
    "month_award": Source(
        "award/{season}/month/award.json",
        f"awards MAP<STRING, ARRAY<{AWARD_ITEM}>>",
        map_column="awards",
    ),
    "season_award": Source(
        "award/{season}/season/award.json",
        "awardTypeId DOUBLE, award STRING, player STRUCT<playerId: DOUBLE>, "
        f"official STRUCT<officialId: DOUBLE>, apiTeam STRUCT<id: DOUBLE>, {RELATED}",
    ),
    "match_info": Source(
        "match/{season}/match_info.json",
        "id DOUBLE, teams ARRAY<STRUCT<team: STRUCT<id: DOUBLE>, score: DOUBLE>>, "
        "kickoff STRUCT<label: STRING>, attendance DOUBLE, gameweek STRUCT<gameweek: DOUBLE>, "
        "clock STRUCT<label: STRING, secs: DOUBLE>, ground STRUCT<id: DOUBLE>",
    ),
    "match_stats": Source(
        "match/{season}/match_stats.json",
        "entity STRUCT<id: DOUBLE, teams: ARRAY<STRUCT<team: STRUCT<id: DOUBLE>>>>, "
        f"stats MAP<STRING, {MATCH_STAT_ITEMS}>",
        many_names=True,
    ),
    "awards": Source(
        "award/{season}/awards.json",
        f"monthAwards MAP<STRING, ARRAY<{AWARD_ITEM}>>, seasonAwards ARRAY<{AWARD_ITEM}>",
    ),
}

PAGE_INFO = "pageInfo STRUCT<page: BIGINT, numPages: BIGINT, pageSize: BIGINT, numEntries: BIGINT>"

Columns = list[tuple[str, str]]

# Wide facts list their fixed columns only; statistics follow as DOUBLE.
TABLES: dict[str, Columns] = {
    "dim_season": [("season_id", "bigint"), ("label", "string")],
    "dim_country": [("country_id", "string"), ("name", "string"), ("demonym", "string")],
    "dim_manager": [
        ("manager_id", "bigint"), ("first_name", "string"), ("lastname", "string"),
        ("dob", "date"), ("country_id", "string"),
    ],
    "dim_club": [
        ("club_id", "bigint"), ("name", "string"), ("short_name", "string"), ("abbr", "string"),
    ],
    "dim_stadium": [
        ("stadium_id", "bigint"), ("name", "string"), ("capacity", "double"), ("city", "string"),
        ("latitude", "double"), ("longitude", "double"),
    ],
    "dim_position": [("position_id", "string"), ("name", "string")],
    "dim_player": [
        ("player_id", "bigint"), ("first_name", "string"), ("lastname", "string"), ("dob", "date"),
        ("shirt_num", "bigint"), ("country_id", "string"), ("position_id", "string"),
    ],
    "dim_award": [("award_id", "bigint"), ("name", "string"), ("type", "string")],
    "dim_match": [
        ("match_id", "bigint"), ("attendance", "decimal(10,0)"), ("game_week", "decimal(10,0)"),
        ("match_length_min", "decimal(10,0)"), ("match_length_sec", "decimal(10,0)"),
        ("date_played", "date"), ("time", "string"), ("home_team_id", "bigint"),
        ("away_team_id", "bigint"), ("home_team_final_score", "decimal(10,0)"),
        ("away_team_final_score", "decimal(10,0)"), ("stadium_id", "bigint"),
    ],
    "fct_club_stat": [
        ("club_id", "bigint"), ("manager_id", "bigint"), ("stadium_id", "bigint"), ("season_id", "bigint"),
    ],
    "fct_player_stat": [("player_id", "bigint"), ("club_id", "bigint"), ("season_id", "bigint")],
    "fct_object_award": [("award_id", "bigint"), ("season_id", "bigint"), ("object_id", "bigint")],
    "fct_match_stat": [("match_id", "bigint"), ("club_id", "bigint"), ("season_id", "bigint")],
}


def with_statistics(table: str, names: list[str]) -> Columns:
    """Columns of a wide fact: its fixed columns, then one DOUBLE per name."""
    return TABLES[table] + [(name, "double") for name in names]


def to_ddl(columns: Columns) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in columns)
