"""The 13 tables, built by the real model code from the derived documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.operators.reshape import distinct_sorted
from sportmart.plans import dims, facts, standins
from sportmart.plans.catalogue.registry import query, season_sql, season_start_sql
from sportmart.plans.catalogue.scalars import KICKOFF_SQL

SEASON_IDS_SQL = f"""
    (SELECT DISTINCT {season_start_sql('o_orderdate')} AS season_id, {season_sql('o_orderdate')} AS season FROM orders
     UNION SELECT {season_start_sql('ts')}, {season_sql('ts')} FROM events)
"""

# birth date of a customer as manager or player
DOB_SQL = "CAST(DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS DATE)"


def whole_numbers(df: DataFrame) -> DataFrame:
    """decimal(10,0) columns as BIGINT, for comparison."""
    return df.select(
        *[
            F.col(column.name).cast("bigint").alias(column.name)
            if column.dataType.simpleString().startswith("decimal")
            else F.col(column.name)
            for column in df.schema
        ]
    )


@query("MDL-1 PRJ-1 SCL-9 SRC-3", f"SELECT season_id, season AS label FROM {SEASON_IDS_SQL}")
def dim_season(t):
    return dims.dim_season(standins.seasons(t))


COUNTRY_SQL = """
    SELECT 'C' || c_nationkey AS country_id, 'NATION_' || c_nationkey AS name, 'Nat' || c_nationkey AS demonym
    FROM customer WHERE (c_mktsegment <> 'FURNITURE' OR c_acctbal <= 9000) AND c_nationkey <> 7
"""


@query("MDL-2 SET-3 AGG-5 FLT-1", f"SELECT DISTINCT * FROM ({COUNTRY_SQL})")
def dim_country(t):
    return dims.dim_country(standins.manager_info(t), standins.player_info(t))


@query(
    "MDL-3 JON-1 FLT-2 SCL-2",
    f"""
    SELECT c_custkey AS manager_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS lastname,
           {DOB_SQL} AS dob, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'C' || c_nationkey END AS country_id
    FROM customer WHERE c_acctbal >= 0
    """,
)
def dim_manager(t):
    return dims.dim_manager(standins.manager_info(t))


@query(
    "MDL-4 SET-3 AGG-5",
    """
    SELECT s_suppkey AS club_id, s_name AS name, 'Club ' || s_suppkey AS short_name, 'C' || s_suppkey AS abbr
    FROM supplier
    UNION SELECT s_suppkey, s_name || ' FC', 'Club ' || s_suppkey, 'C' || s_suppkey FROM supplier WHERE s_acctbal < 1000
    """,
)
def dim_club(t):
    """Whole-row distinct: a club that changed its name has two rows."""
    return dims.dim_club(standins.club_info(t))


@query(
    "MDL-4",
    """
    SELECT s_suppkey AS club_id, s_name || CASE WHEN s_acctbal < 1000 THEN ' FC' ELSE '' END AS name,
           'Club ' || s_suppkey AS short_name, 'C' || s_suppkey AS abbr
    FROM supplier
    """,
)
def dim_club_latest(t):
    """One row per club, from its latest season."""
    return dims.dim_club(standins.club_info(t), latest=True)


@query(
    "MDL-5 NST-1",
    """
    SELECT s_suppkey * 10 + i AS stadium_id, 'Ground ' || (s_suppkey * 10 + i) AS name, s_acctbal * 10 AS capacity,
           'City ' || s_nationkey AS city, s_acctbal / 100 AS latitude, -s_acctbal / 100 AS longitude
    FROM supplier, (VALUES (0), (1)) AS g(i) WHERE s_acctbal >= 500 AND (i = 0 OR s_acctbal >= 5000)
    """,
)
def dim_stadium(t):
    return dims.dim_stadium(standins.club_info(t))


SEGMENT_SQL = "upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2))"


@query(
    "MDL-6 SCL-1 FLT-1",
    f"""
    SELECT DISTINCT left(c_mktsegment, 1) || 'LWB' AS position_id, {SEGMENT_SQL} || ' Lead/Wide Back' AS name
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
)
def dim_position(t):
    return dims.dim_position(standins.player_info(t))


PLAYER_SQL = f"""
    SELECT c_custkey AS player_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS lastname,
           {DOB_SQL} AS dob, CAST(c_custkey % 99 AS BIGINT) AS shirt_num,
           CASE WHEN c_acctbal <= 9000 THEN 'C' || c_nationkey END AS country_id,
           left(c_mktsegment, 1) || 'LWB' AS position_id
    FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
"""


@query("MDL-7 JON-4 JON-5 FLT-2", PLAYER_SQL)
def dim_player(t):
    return dims.dim_player(standins.player_info(t))


SEASON_AWARD_ID_SQL = """CASE c_mktsegment WHEN 'BUILDING' THEN 5 WHEN 'MACHINERY' THEN 11 WHEN 'AUTOMOBILE' THEN 12
    WHEN 'HOUSEHOLD' THEN 13 WHEN 'FURNITURE' THEN 14 END"""


@query(
    "MDL-8 SET-1 PRJ-4 NST-3 AGG-5",
    f"""
    SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS award_id, substr(o_orderpriority, 3) AS name, 'month' AS type
    FROM orders
    UNION SELECT CAST({SEASON_AWARD_ID_SQL} AS BIGINT), c_mktsegment, 'season' FROM customer
    """,
)
def dim_award(t):
    return dims.dim_award(standins.month_award(t), standins.season_award(t))


@query(
    "MDL-9 PRJ-9 PRJ-10 SCL-4 SCL-5 SCL-6 SET-2",
    f"""
    SELECT o_orderkey AS match_id, CAST(CAST(o_totalprice AS DECIMAL(10,0)) AS BIGINT) AS attendance,
           CAST(o_orderkey % 38 + 1 AS BIGINT) AS game_week,
           CASE o_orderstatus WHEN 'F' THEN 90 + o_orderkey % 9 WHEN 'O' THEN 45 END::BIGINT AS match_length_min,
           CAST(CAST(o_totalprice / 100 AS DECIMAL(10,0)) AS BIGINT) AS match_length_sec,
           CAST({KICKOFF_SQL} AS DATE) AS date_played, strftime({KICKOFF_SQL}, '%H:%M') AS time,
           o_custkey AS home_team_id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 1 END AS away_team_id,
           CAST(o_orderkey % 6 + 1 AS BIGINT) AS home_team_final_score,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 4 AS BIGINT) END AS away_team_final_score,
           o_custkey * 10 AS stadium_id
    FROM orders
    """,
)
def dim_match(t):
    return whole_numbers(dims.dim_match(standins.match_info(t)))


CLUB_FACT_SQL = f"""
    WITH long AS (
        SELECT {season_sql('l_shipdate')} AS season, l_suppkey AS club_id, l_returnflag AS flag, l_linestatus,
               l_quantity AS value
        FROM lineitem WHERE l_quantity < 50),
    wide AS (
        SELECT season, club_id, sum(value) FILTER (WHERE flag = 'N') AS draws,
               sum(value) FILTER (WHERE flag = 'R') AS losses, sum(value) FILTER (WHERE flag = 'A') AS wins
        FROM long GROUP BY season, club_id),
    grounds AS (
        SELECT DISTINCT season, club_id, club_id * 10 + i AS stadium_id FROM long, (VALUES (0), (1)) AS g(i)
        WHERE i = 0 OR l_linestatus = 'F'),
    managers AS (
        SELECT c_custkey AS manager_id, CAST(floor(c_custkey / 2) AS BIGINT) AS club_id,
               y || '-' || right(CAST(y + 1 AS VARCHAR), 2) AS season
        FROM (SELECT *, unnest(range(1996, 1997 + c_nationkey % 4)) AS y FROM customer)
        WHERE c_mktsegment <> 'HOUSEHOLD')
    SELECT w.club_id, m.manager_id, g.stadium_id, s.season_id, w.draws, w.losses, w.wins
    FROM wide w JOIN grounds g USING (season, club_id) JOIN managers m USING (season, club_id)
    JOIN {SEASON_IDS_SQL} s USING (season)
    """


@query("MDL-10 JON-2 JON-3 NST-1 NST-2 AGG-1 PRJ-4", CLUB_FACT_SQL)
def fct_club_stat(t):
    return facts.fct_club_stat(
        standins.club_stats(t), standins.manager_info(t), standins.seasons(t), standins.CLUB_NAMES
    )


@query(
    "MDL-10 AGG-6 SRT-2 JON-2",
    f"""
    SELECT season_id, club_id, count(*) AS n, max(draws) AS draws, max(losses) AS losses, max(wins) AS wins
    FROM ({CLUB_FACT_SQL}) GROUP BY season_id, club_id
    """,
)
def club_season_totals(t):
    """Statistics once per club and season, their names found in the data.

    The fact repeats statistics per manager and ground, so one row of a club is taken.
    """
    names = distinct_sorted(standins.club_stats(t), "entity", limit=1000)
    fact = facts.fct_club_stat(standins.club_stats(t), standins.manager_info(t), standins.seasons(t), names)
    return fact.groupBy("season_id", "club_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(name).alias(name) for name in fact.columns[4:]]
    )


@query(
    "MDL-11 JON-6 AGG-2 AGG-4 PRJ-6 PRJ-7",
    f"""
    WITH long AS (
        SELECT {season_sql('ts')} AS season, user_id AS player_id, upper(event_type) AS name, round(value * 100) AS value,
               CASE WHEN event_type <> 'signup' THEN user_id % 20 END AS club_id
        FROM events),
    wide AS (
        SELECT season, player_id, sum(value) FILTER (WHERE name = 'CLICK') AS "CLICK",
               sum(value) FILTER (WHERE name = 'ERROR') AS "ERROR",
               sum(value) FILTER (WHERE name = 'PURCHASE') AS "PURCHASE", CAST(NULL AS DOUBLE) AS "REFUND",
               sum(value) FILTER (WHERE name = 'VIEW') AS "VIEW"
        FROM long GROUP BY season, player_id)
    SELECT w.player_id, c.club_id, s.season_id, "CLICK", "ERROR", "PURCHASE", "REFUND", "VIEW"
    FROM wide w JOIN (SELECT DISTINCT season, player_id, club_id FROM long) c USING (season, player_id)
    JOIN {SEASON_IDS_SQL} s USING (season)
    """,
)
def fct_player_stat(t):
    return facts.fct_player_stat(standins.player_stats(t), standins.seasons(t), standins.PLAYER_NAMES)


BRIDGE_SQL = f"""
    SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS award_id, s.season_id,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS object_id
    FROM orders JOIN {SEASON_IDS_SQL} s ON s.season = {season_sql('o_orderdate')}
    UNION ALL
    SELECT CAST({SEASON_AWARD_ID_SQL} AS BIGINT), s.season_id,
           CASE WHEN c_acctbal < 0 THEN c_nationkey ELSE c_custkey END
    FROM customer JOIN {SEASON_IDS_SQL} s ON s.season = CASE WHEN c_nationkey < 12 THEN '1999-00' ELSE '2000-01' END
"""


@query("MDL-12 SET-2 SCL-11 PRJ-3 NST-3", BRIDGE_SQL)
def fct_object_award(t):
    return facts.fct_object_award(standins.month_award(t), standins.season_award(t), standins.seasons(t))


@query("MDL-12 JON-7 JON-8", f"SELECT * FROM ({BRIDGE_SQL}) WHERE award_id IN (5, 11, 12, 13, 14)")
def bridge_award_known(t):
    """Awards given, for the ids of an award table that only knows season awards."""
    season_award = standins.season_award(t)
    known = dims.dim_award(standins.month_award(t).where(F.lit(False)), season_award)
    return facts.fct_object_award(standins.month_award(t), season_award, standins.seasons(t), known)


@query(
    "JON-7 JON-8 MDL-12",
    f"""
    SELECT b.* FROM ({BRIDGE_SQL}) b JOIN (
        SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS award_id, o_orderpriority AS name FROM orders
        UNION SELECT CAST({SEASON_AWARD_ID_SQL} AS BIGINT), c_mktsegment FROM customer) a USING (award_id)
    """,
)
def bridge_award_fan_out(t):
    """The same with one row per name of the award: id 5 counts twice."""
    awards = dims.dim_award(standins.month_award(t), standins.season_award(t))
    return facts.fct_object_award(
        standins.month_award(t), standins.season_award(t), standins.seasons(t), awards, fan_out=True
    )


@query(
    "MDL-13 AGG-3 NST-5 NST-6 JON-10",
    f"""
    SELECT l_orderkey AS match_id, l_suppkey AS club_id, s.season_id, max(l_quantity) AS duel_lost,
           CAST(max(l_linenumber) AS DOUBLE) AS fk_foul_lost, CAST(433 AS DOUBLE) AS formation_used
    FROM lineitem JOIN {SEASON_IDS_SQL} s ON s.season = {season_sql('l_shipdate')}
    GROUP BY l_orderkey, l_suppkey, s.season_id
    """,
)
def fct_match_stat(t):
    return facts.fct_match_stat(standins.match_stats(t), standins.seasons(t), standins.MATCH_NAMES)


@query(
    "ING-6 JON-10 MDL-13",
    f"""
    SELECT l_orderkey AS match_id, l_suppkey AS club_id, s.season_id, max(l_quantity) AS duel_lost
    FROM lineitem JOIN {SEASON_IDS_SQL} s ON s.season = {season_sql('l_shipdate')}
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    GROUP BY l_orderkey, l_suppkey, s.season_id
    """,
)
def listed_match_stats(t):
    """Match statistics of the matches in a listing only."""
    finished = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("double").alias("id"))
    return facts.fct_match_stat(
        standins.match_stats(t), standins.seasons(t), ["duel_lost"], match_info=finished
    )
