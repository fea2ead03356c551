"""Fact tables from source frames.

Statistics are folded to one row per owner, season and name before anything
is joined, and the season id joins last, onto the folded rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sportmart.functions import season_label
from sportmart.operators.nested import explode_path, map_to_rows
from sportmart.operators.pages import documents_for_ids
from sportmart.operators.reshape import long_to_wide
from sportmart.operators.sets import align_to, union_fill
from sportmart.plans.dims import as_id, month_award_items
from sportmart.schemas import TABLES, with_statistics


def with_season_id(df: DataFrame, seasons: DataFrame) -> DataFrame:
    """Season label -> season id; rows of unlisted seasons drop out.

    ``df`` is folded already. Adaptive execution sees the size of the index
    when it has run: it broadcasts a small one, and splits a season that
    holds most rows if it has to shuffle.
    """
    index = seasons.select(
        as_id("id").alias("season_id"), season_label(F.col("label")).alias("season")
    ).distinct()
    return df.join(index, "season")


def total_over(
    folded: DataFrame, keys: Sequence[str], names: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Statistics added up over ``keys`` and repeated on every row.

    ``folded`` already has one row per ``keys`` and ``keep``, so a partition
    holds the few variants of an owner. This reads the source once, where
    joining totals with the variants reads it twice.
    """
    owner = Window.partitionBy(*keys)
    return folded.select(*keys, *keep, *[F.sum(f"`{name}`").over(owner).alias(name) for name in names])


def club_statistics(club_stats: DataFrame, *extra: Column) -> DataFrame:
    """Long club statistics (season, club_id, stat_name, stat_value)."""
    return explode_path(club_stats, "stats", "s", keep=["season"]).select(
        "season",
        as_id("s.owner.club.id").alias("club_id"),
        F.col("s.name").alias("stat_name"),
        F.col("s.value").alias("stat_value"),
        *extra,
    )


def fct_club_stat(
    club_stats: DataFrame,
    manager_info: DataFrame,
    seasons: DataFrame,
    names: Sequence[str],
) -> DataFrame:
    """Club statistics at the grain club x manager x stadium x season.

    A club without a manager or a ground in the season drops out; several
    managers or grounds repeat its statistics, so sums over this table
    overcount. ``names`` are the statistics that become columns.
    """
    long = club_statistics(club_stats, F.col("s.owner.grounds.id").alias("grounds")).where("club_id IS NOT NULL")
    by_grounds = long_to_wide(
        long, ["season", "club_id", "grounds"], "stat_name", "stat_value", names, null_keys=True
    )
    wide = (
        total_over(by_grounds, ["season", "club_id"], names, keep=["grounds"])
        .withColumn("ground", F.explode("grounds"))
        .withColumn("stadium_id", as_id("ground"))
        .drop("grounds", "ground")
        # the statistics follow from the club and season
        .dropDuplicates(["season", "club_id", "stadium_id"])
    )
    managers = manager_info.select(
        "season", as_id("currentTeam.id").alias("club_id"), as_id("officialId").alias("manager_id")
    ).where("club_id IS NOT NULL").distinct()
    rows = wide.join(managers, ["season", "club_id"])
    return align_to(with_season_id(rows, seasons), with_statistics("fct_club_stat", list(names)))


def player_statistics(player_stats: DataFrame) -> DataFrame:
    """Long player statistics (season, player_id, club_id, stat_name, stat_value), names in upper case."""
    return explode_path(player_stats, "stats", "s", keep=["season"]).select(
        "season",
        as_id("s.owner.playerId").alias("player_id"),
        as_id("s.owner.currentTeam.club.id").alias("club_id"),
        F.upper("s.name").alias("stat_name"),
        F.col("s.value").alias("stat_value"),
    )


def fct_player_stat(player_stats: DataFrame, seasons: DataFrame, names: Sequence[str]) -> DataFrame:
    """Player statistics per season, one row per club seen for the player.

    ``names`` (upper case) is the fixed list of statistics of the target:
    others are dropped, absent ones are null.
    """
    long = player_statistics(player_stats).where("player_id IS NOT NULL")
    by_club = long_to_wide(
        long, ["season", "player_id", "club_id"], "stat_name", "stat_value", names, null_keys=True
    )
    rows = total_over(by_club, ["season", "player_id"], names, keep=["club_id"])
    return align_to(with_season_id(rows, seasons), with_statistics("fct_player_stat", list(names)))


def fct_object_award(
    month_award: DataFrame,
    season_award: DataFrame,
    seasons: DataFrame,
    awards: DataFrame | None = None,
    fan_out: bool = False,
) -> DataFrame:
    """One row per award given; the object is the player, else the manager, else the club.

    ``awards`` restricts to the ids of a dim_award; without it every award
    with an id counts, as in a dim_award built from the same sources. An
    award counts once however many names its id has; ``fan_out`` repeats it
    per dimension row.
    """
    month = month_award_items(month_award).select(
        as_id("awardTypeId").alias("award_id"),
        as_id("player.playerId").alias("player_id"),
        as_id("official.officialId").alias("manager_id"),
        "season",
    )
    season = season_award.select(
        as_id("awardTypeId").alias("award_id"),
        as_id("player.playerId").alias("player_id"),
        as_id("official.officialId").alias("manager_id"),
        as_id("apiTeam.id").alias("club_id"),
        "season",
    )
    given = union_fill([month, season])
    if awards is None:
        given = given.where("award_id IS NOT NULL")
    elif fan_out:
        given = given.join(awards.select("award_id"), "award_id")
    else:
        given = documents_for_ids(awards.select("award_id"), given, "award_id")
    given = given.withColumn("object_id", F.coalesce("player_id", "manager_id", "club_id"))
    return align_to(with_season_id(given, seasons), TABLES["fct_object_award"])


def match_statistics(match_stats: DataFrame) -> DataFrame:
    """Long match statistics (season, match_id, club_id, stat_name, stat_value).

    Statistics of a club that the document does not list as a team are left
    out. Teams and statistics sit in one document, so this is a filter.
    """
    entries = map_to_rows(match_stats, "stats", "club", "entry", keep=["season", "entity"])
    club_id = F.col("club").try_cast("bigint")
    played = entries.where(F.array_contains("entity.teams.team.id", club_id.cast("double"))).select(
        "season", as_id("entity.id").alias("match_id"), club_id.alias("club_id"), F.col("entry.M").alias("items")
    )
    return explode_path(played, "items", "m", keep=["season", "match_id", "club_id"]).select(
        "season", "match_id", "club_id", F.col("m.name").alias("stat_name"), F.col("m.value").alias("stat_value")
    )


def fct_match_stat(
    match_stats: DataFrame,
    seasons: DataFrame,
    names: Sequence[str],
    match_info: DataFrame | None = None,
) -> DataFrame:
    """Match statistics per match and club, for the clubs that played the match.

    ``match_info`` restricts the matches to a listing; ``names`` are the
    statistics that become columns.
    """
    long = match_statistics(match_stats)
    key = ["season", "match_id", "club_id"]
    wide = long_to_wide(long, key, "stat_name", "stat_value", names, agg="max", listed_only=True)
    if match_info is not None:
        # folded rows are what shuffles; a listing that can be broadcast is
        # pushed below the fold by the optimizer
        wide = documents_for_ids(match_info.select(as_id("id").alias("match_id")), wide, "match_id")
    return align_to(with_season_id(wide, seasons), with_statistics("fct_match_stat", list(names)))
