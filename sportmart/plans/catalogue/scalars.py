"""Queries for the scalar functions and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.functions import (
    academic_year,
    clock_minutes,
    has_column,
    hms,
    initials,
    local_date,
    local_time,
    london_to_local,
    nth,
    object_keys,
    parse_long_date,
    path_or_null,
    season_label,
)
from sportmart.functions.sql import register_functions
from sportmart.operators.pages import current_season, first_seasons
from sportmart.plans import standins
from sportmart.plans.catalogue.registry import query, season_sql


@query(
    "SCL-1 UDF-1",
    """
    SELECT p_partkey,
           array_to_string(list_transform(regexp_split_to_array(p_name || '/' || p_type, '[ /]'),
                                          lambda w: w[1]), '') AS initials
    FROM part
    """,
)
def initials_of_names(t):
    return t.part.select("p_partkey", initials(F.concat("p_name", F.lit("/"), "p_type")).alias("initials"))


@query(
    "SCL-2 UDF-2",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus <> 'P'
                THEN CAST(strptime(strftime(o_orderdate, '%-d %B %Y'), '%d %B %Y') AS DATE) END AS dob
    FROM orders
    """,
)
def long_date(t):
    """Dates in words, some of them not dates at all."""
    text = F.when(F.col("o_orderstatus") == "P", "no date").otherwise(F.date_format("o_orderdate", "d MMMM yyyy"))
    return t.orders.select("o_orderkey", parse_long_date(text).alias("dob"))


KICKOFF_SQL = """(((o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)))
    AT TIME ZONE 'Europe/London') AT TIME ZONE 'Asia/Ho_Chi_Minh')"""


@query(
    "SCL-3 SCL-4 SCL-5 UDF-3 UDF-4",
    f"""
    SELECT o_orderkey, {KICKOFF_SQL} AS local_ts, CAST({KICKOFF_SQL} AS DATE) AS date_played,
           strftime({KICKOFF_SQL}, '%H:%M') AS time
    FROM orders
    """,
)
def kickoff_local(t):
    label = standins.kickoff_label()
    return t.orders.select(
        "o_orderkey",
        london_to_local(label).alias("local_ts"),
        local_date(label).alias("date_played"),
        local_time(label).alias("time"),
    )


@query(
    "UDF-1 UDF-2 UDF-3 UDF-4 UDF-5",
    f"""
    SELECT o_orderkey, array_to_string(list_transform(regexp_split_to_array(o_orderpriority, '[ /]'), lambda w: w[1]), '') AS initials,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS dob,
           CAST({KICKOFF_SQL} AS DATE) AS date_played, strftime({KICKOFF_SQL}, '%H:%M') AS time,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderkey % 90 AS INTEGER) + 5 END AS minutes
    FROM orders
    """,
)
def functions_in_sql(t):
    """The scalars by name in SQL text."""
    register_functions(t.spark)
    texts = t.orders.select(
        "o_orderkey", "o_orderpriority", standins.kickoff_label().alias("kickoff"),
        F.when(F.col("o_orderstatus") == "P", "no date").otherwise(F.date_format("o_orderdate", "d MMMM yyyy")).alias("birth"),
        F.concat((F.col("o_orderkey") % 90).cast("string"), F.lit(" +"), F.when(F.col("o_orderstatus") == "F", "x").otherwise("5"),
                 F.lit("'00")).alias("clock"),
    )
    return t.spark.sql(
        """
        SELECT o_orderkey, initials(o_orderpriority) AS initials, parse_long_date(birth) AS dob, local_date(kickoff) AS date_played,
               local_time(kickoff) AS time, clock_minutes(clock) AS minutes
        FROM {texts}
        """,
        texts=texts,
    )


@query(
    "SCL-6 UDF-5",
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN NULL
                WHEN l_returnflag = 'N' THEN CAST(l_quantity AS INTEGER)
                ELSE CAST(l_quantity AS INTEGER) + l_linenumber END AS minutes
    FROM lineitem
    """,
)
def clock_minutes_of_play(t):
    """Clock texts with and without added time; a third does not parse."""
    played = F.col("l_quantity").cast("int").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(played, F.lit(" +x'00")))
        .when(F.col("l_returnflag") == "N", played)
        .otherwise(F.concat(played, F.lit(" +"), F.col("l_linenumber").cast("string"), F.lit("'00")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", clock_minutes(text).alias("minutes"))


@query(
    "SCL-7 SCL-9 FLT-5",
    f"""
    SELECT o_orderkey, {season_sql('o_orderdate')} AS season,
           replace(year(o_orderdate) || '/' || right(CAST(year(o_orderdate) AS VARCHAR), 2), '/', '-') AS label
    FROM orders
    """,
)
def academic_years(t):
    label = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("/"), F.date_format("o_orderdate", "yy"))
    return t.orders.select(
        "o_orderkey", academic_year(F.col("o_orderdate")).alias("season"), season_label(label).alias("label")
    )


@query(
    "SCL-8",
    """
    SELECT event_id,
           printf('%02d:%02d:%02d', s // 3600, (s // 60) % 60, s % 60) AS elapsed
    FROM (SELECT event_id, CAST(round_even(value * 100, 0) AS BIGINT) AS s FROM events)
    """,
)
def elapsed_hms(t):
    return t.events.select("event_id", hms(F.col("value") * 100).alias("elapsed"))


@query(
    "PRJ-10",
    """
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(10,0)) AS BIGINT) AS price,
           CAST(CAST(l_quantity / 2 AS DECIMAL(10,0)) AS BIGINT) AS half, CAST(l_shipdate AS DATE) AS shipped
    FROM lineitem
    """,
)
def decimal_round(t):
    """Casts to decimal(10,0) round half up; casts to date drop the time."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(10,0)").cast("bigint").alias("price"),
        (F.col("l_quantity") / 2).cast("decimal(10,0)").cast("bigint").alias("half"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


@query(
    "PRJ-1 PRJ-5 PRJ-6",
    """
    SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.owner.id' AS BIGINT) AS owner_id,
           CAST(NULL AS BIGINT) AS team_id
    FROM events
    """,
)
def json_path_or_null(t):
    """A path in the data, a declared one the data lacks, an undeclared one."""
    parsed = t.events.select(
        "event_id", F.from_json("props", "k BIGINT, owner STRUCT<id: BIGINT>").alias("doc")
    )
    return parsed.select(
        "event_id",
        path_or_null(parsed, "doc.k", "bigint").alias("k"),
        path_or_null(parsed, "doc.owner.id", "bigint").alias("owner_id"),
        path_or_null(parsed, "doc.currentTeam.club.id", "bigint").alias("team_id"),
    )


@query(
    "PRJ-9 PRJ-10",
    """
    SELECT o_orderkey, o_custkey AS home_team_id,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 1 END AS away_team_id,
           CAST(o_orderkey % 6 + 1 AS BIGINT) AS home_score,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 4 AS BIGINT) END AS away_score
    FROM orders
    """,
)
def pair_elements(t):
    """Home and away team by position; a one-element array has no away team."""
    return standins.match_info(t).select(
        F.col("id").cast("bigint").alias("o_orderkey"),
        nth("teams", 0, "team.id").cast("bigint").alias("home_team_id"),
        nth("teams", 1, "team.id").cast("bigint").alias("away_team_id"),
        nth("teams", 0, "score").cast("decimal(10,0)").cast("bigint").alias("home_score"),
        nth("teams", 1, "score").cast("decimal(10,0)").cast("bigint").alias("away_score"),
    )


@query(
    "PRJ-2 PRJ-3 PRJ-4 PRJ-5 SCL-14",
    """
    SELECT p_partkey, upper(p_name) AS p_name, p_retailprice * 2 AS double_price, 'season' AS type,
           CAST(NULL AS BIGINT) AS club_id
    FROM part
    """,
)
def computed_columns(t):
    """Columns overwritten, computed, constant, typed null and dropped in one projection."""
    return (
        t.part.withColumns(
            {
                "p_name": F.upper("p_name"),
                "double_price": F.col("p_retailprice") * 2,
                "type": F.lit("season"),
                "club_id": F.col("club_id") if has_column(t.part, "club_id") else F.lit(None).cast("bigint"),
            }
        ).drop("p_brand", "p_type", "p_size", "p_retailprice")
    )


@query(
    "NST-7",
    "SELECT event_id, unnest(json_keys(props)) AS key FROM events",
)
def json_keys(t):
    return t.events.select("event_id", F.explode(object_keys(F.col("props"))).alias("key"))


@query(
    "FLT-1 FLT-2",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM
        (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                nullif(o_orderpriority, '5-LOW') AS o_orderpriority, nullif(month(o_orderdate), 5) AS m FROM orders)
    WHERE o_orderstatus IS NOT NULL AND m IS NOT NULL
    """,
)
def drop_incomplete(t):
    """Rows without nulls in named columns; other nulls stay."""
    return (
        t.orders.select(
            "o_orderkey",
            F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
            F.nullif(F.month("o_orderdate"), F.lit(5)).alias("m"),
        )
        .dropna(subset=["o_orderstatus", "m"])
        .drop("m")
    )


@query(
    "LIM-1 SRT-1 SRC-3",
    f"""
    SELECT o_orderkey, {season_sql('o_orderdate')} AS season FROM orders
    WHERE {season_sql('o_orderdate')} IN
        (SELECT DISTINCT {season_sql('o_orderdate')} FROM orders ORDER BY 1 LIMIT 3)
    """,
)
def season_filter_limit(t):
    """Orders of the first three seasons of the index."""
    index = standins.seasons(t).select(season_label(F.col("label")).alias("season"))
    first = first_seasons(index, 3, "season")
    orders = t.orders.select("o_orderkey", academic_year(F.col("o_orderdate")).alias("season"))
    return orders.join(first, "season", "left_semi").select("o_orderkey", "season")


@query(
    "FLT-5 SRC-3",
    f"""
    SELECT event_id, {season_sql('ts')} AS season FROM events
    WHERE {season_sql('ts')} = (SELECT max({season_sql('ts')}) FROM events)
    """,
)
def current_season_rows(t):
    """Events of the last season of the index."""
    index = standins.seasons(t).select(season_label(F.col("label")).alias("label"))
    last = current_season(index).select(F.col("label").alias("season"))
    events = t.events.select("event_id", academic_year(F.col("ts")).alias("season"))
    return events.join(last, "season", "left_semi").select("event_id", "season")
