"""Dimension tables from source frames.

A source frame covers any number of seasons and carries ``season``. Builders
project, clean and de-duplicate whole rows; with ``latest=True`` a business
key keeps only its row of the latest season.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sportmart.functions import (
    clock_minutes,
    clock_text,
    initials,
    london_to_local,
    nth,
    parse_long_date,
    season_label,
)
from sportmart.operators.nested import explode_path
from sportmart.operators.pages import award_rows
from sportmart.operators.sets import align_to, has_whole_key, latest_whole, union_all
from sportmart.schemas import TABLES


def as_id(path: str | Column) -> Column:
    return (F.col(path) if isinstance(path, str) else path).cast("bigint")


def conform(frames: Sequence[DataFrame], table: str, latest: bool, key: str | None = None) -> DataFrame:
    """Union of aligned frames, once per row or once per key."""
    columns = TABLES[table]
    if not latest:
        return union_all(frames, columns).distinct()
    rows = union_all(frames, [*columns, ("season", "string")])
    keys = [key or columns[0][0]]
    whole = has_whole_key(keys)
    # without a key there is no latest row; what is left is once per row
    loose = rows.where(f"NOT ({whole})").drop("season").distinct()
    return latest_whole(rows.where(whole), keys, ["season"]).drop("season").union(loose)


def combined(df: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Every combination of the distinct non-null values that a key has in each of its parts.

    The parts are structs. They are gathered in one pass, distinct before the
    shuffle; a key that lacks a part drops out. A key has as many values of a
    part as its entries truly differ.
    """
    grouped = df.groupBy(*keys).agg(*[F.collect_set(part).alias(part) for part in parts])
    for part in parts:
        grouped = grouped.withColumn(part, F.explode(part))
    return grouped.select(*keys, *[f"{part}.*" for part in parts])


def dim_season(seasons: DataFrame) -> DataFrame:
    return align_to(
        seasons.select(as_id("id").alias("season_id"), season_label(F.col("label")).alias("label")),
        TABLES["dim_season"],
    )


def _countries(df: DataFrame, country: str) -> DataFrame:
    return df.select(
        F.col(f"{country}.isoCode").alias("country_id"),
        F.col(f"{country}.country").alias("name"),
        F.col(f"{country}.demonym").alias("demonym"),
        "season",
    ).dropna("any", subset=["country_id", "name", "demonym"])


def dim_country(manager_info: DataFrame, player_info: DataFrame, latest: bool = False) -> DataFrame:
    """Birth countries of managers and national teams of players; no nulls."""
    frames = [_countries(manager_info, "birth.country"), _countries(player_info, "nationalTeam")]
    return conform(frames, "dim_country", latest)


def dim_manager(manager_info: DataFrame, latest: bool = False) -> DataFrame:
    """Managers with a birth date, paired with every country given for their id in the season."""
    person = F.struct(
        F.col("name.first").alias("first_name"), F.col("name.last").alias("lastname"),
        parse_long_date(F.col("birth.date.label")).alias("dob"),
    )
    parts = manager_info.where(F.col("officialId").isNotNull()).select(
        "season",
        as_id("officialId").alias("manager_id"),
        F.when(F.col("birth.date.label").isNotNull(), person).alias("person"),
        F.struct(F.col("birth.country.isoCode").alias("country_id")).alias("country"),
    )
    return conform([combined(parts, ["season", "manager_id"], ["person", "country"])], "dim_manager", latest)


def dim_club(club_info: DataFrame, latest: bool = False) -> DataFrame:
    clubs = club_info.select(
        as_id("id").alias("club_id"),
        "name",
        F.col("club.shortName").alias("short_name"),
        F.col("club.abbr").alias("abbr"),
        "season",
    )
    return conform([clubs], "dim_club", latest)


def dim_stadium(club_info: DataFrame, latest: bool = False) -> DataFrame:
    """Grounds of all clubs; a club without grounds adds none."""
    grounds = explode_path(club_info, "grounds", "ground", keep=["season"]).select(
        as_id("ground.id").alias("stadium_id"),
        "ground.name",
        "ground.capacity",
        "ground.city",
        "ground.location.latitude",
        "ground.location.longitude",
        "season",
    )
    return conform([grounds], "dim_stadium", latest)


def _positions(player_info: DataFrame) -> DataFrame:
    """Position names with the initials that identify them."""
    return (
        player_info.select(
            F.col("info.position").alias("code"), F.col("info.positionInfo").alias("name"), "season"
        )
        .where("code IS NOT NULL AND name IS NOT NULL")
        .withColumn("position_id", initials(F.col("name")))
    )


def dim_position(player_info: DataFrame, latest: bool = False) -> DataFrame:
    return conform([_positions(player_info)], "dim_position", latest)


def dim_player(player_info: DataFrame, latest: bool = False) -> DataFrame:
    """Players with a birth date and a position; the country may be null.

    Facts of one player on several entries of a season combine; copies of an
    entry do not multiply.
    """
    person = F.struct(
        F.col("name.first").alias("first_name"), F.col("name.last").alias("lastname"),
        parse_long_date(F.col("birth.date.label")).alias("dob"), as_id("info.shirtNum").alias("shirt_num"),
    )
    position = F.struct(initials(F.col("info.positionInfo")).alias("position_id"))
    named = F.col("info.position").isNotNull() & F.col("info.positionInfo").isNotNull()
    parts = player_info.where(F.col("playerId").isNotNull()).select(
        "season",
        as_id("playerId").alias("player_id"),
        F.when(F.col("birth.date.label").isNotNull(), person).alias("person"),
        F.struct(F.col("nationalTeam.isoCode").alias("country_id")).alias("country"),
        F.when(named, position).alias("position"),
    )
    return conform([combined(parts, ["season", "player_id"], ["person", "country", "position"])], "dim_player", latest)


def month_award_items(month_award: DataFrame) -> DataFrame:
    return award_rows(month_award, keep=["season"]).select("season", "month", "award_month.*")


def dim_award(month_award: DataFrame, season_award: DataFrame, latest: bool = False) -> DataFrame:
    frames = [
        items.select(
            as_id("awardTypeId").alias("award_id"),
            F.col("award").alias("name"),
            F.lit(kind).alias("type"),
            "season",
        )
        for items, kind in ((month_award_items(month_award), "month"), (season_award, "season"))
    ]
    return conform(frames, "dim_award", latest)


def dim_match(match_info: DataFrame, latest: bool = False) -> DataFrame:
    """One row per match document; ``latest`` keeps one per match id."""
    measure = "decimal(10,0)"
    # converted in a column of its own, so that date and time share the work
    matches = match_info.withColumn("_local", london_to_local(F.col("kickoff.label"))).select(
        as_id("id").alias("match_id"),
        F.col("attendance").cast(measure).alias("attendance"),
        F.col("gameweek.gameweek").cast(measure).alias("game_week"),
        clock_minutes(F.col("clock.label")).cast(measure).alias("match_length_min"),
        F.col("clock.secs").cast(measure).alias("match_length_sec"),
        F.to_date("_local").alias("date_played"),
        clock_text(F.col("_local")).alias("time"),
        as_id(nth("teams", 0, "team.id")).alias("home_team_id"),
        as_id(nth("teams", 1, "team.id")).alias("away_team_id"),
        nth("teams", 0, "score").cast(measure).alias("home_team_final_score"),
        nth("teams", 1, "score").cast(measure).alias("away_team_final_score"),
        as_id("ground.id").alias("stadium_id"),
        "season",
    )
    if latest:
        return conform([matches], "dim_match", True)
    return align_to(matches, TABLES["dim_match"])
