"""Queries for nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.operators.nested import (
    collect_flatten,
    explode_chain,
    explode_path,
    flatten_arrays,
    map_items_to_rows,
    map_to_rows,
    stack_array_columns,
    star,
)
from sportmart.plans import standins
from sportmart.plans.catalogue.registry import query

PIECE = 1000


@query(
    "AGG-4 NST-1 NST-4",
    "SELECT event_type AS entity, event_id, user_id, value FROM events",
)
def nested_roundtrip(t):
    """Events nested per type in pieces of at most 1000, then exploded again."""
    envelopes = t.events.select(
        F.col("event_type").alias("entity"), "event_id", F.array(F.struct("event_id", "user_id", "value")).alias("stats")
    )
    pieces = collect_flatten(envelopes, ["entity"], "stats", F.floor(F.col("event_id") / PIECE))
    return star(explode_path(pieces, "stats", "s", keep=["entity"]), "s", keep=["entity"])


@query(
    "AGG-4",
    f"""
    SELECT event_type AS entity, CAST(event_id // {PIECE} AS BIGINT) AS part, count(*) AS n,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM events GROUP BY 1, 2
    """,
)
def nested_pieces(t):
    """The joined arrays themselves: their length and their sorted members."""
    envelopes = t.events.select(F.col("event_type").alias("entity"), "event_id", F.array("event_id").alias("ids"))
    pieces = collect_flatten(envelopes, ["entity"], "ids", F.floor(F.col("event_id") / PIECE))
    return pieces.select(
        "entity",
        "part",
        F.size("ids").cast("bigint").alias("n"),
        F.array_join(F.array_sort("ids"), ",").alias("ids"),
    )


@query(
    "NST-1",
    """
    SELECT s_suppkey AS club_id, s_suppkey * 10 + i AS stadium_id, s_acctbal * 10 AS capacity, season
    FROM supplier, (VALUES (0), (1)) AS g(i), (VALUES ('1999-00'), ('2000-01')) AS y(season)
    WHERE s_acctbal >= 500 AND (i = 0 OR s_acctbal >= 5000)
    """,
)
def explode_drops_empty(t):
    """Clubs with null or empty grounds give no rows."""
    grounds = explode_path(standins.club_info(t), "grounds", "g", keep=["id", "season"])
    return grounds.select(
        F.col("id").cast("bigint").alias("club_id"),
        F.col("g.id").cast("bigint").alias("stadium_id"),
        F.col("g.capacity").alias("capacity"),
        "season",
    )


@query(
    "NST-2",
    """
    SELECT l_returnflag AS flag, CASE WHEN l_quantity < 50 THEN l_suppkey END AS club_id,
           l_suppkey * 10 + i AS stadium_id, l_quantity AS value
    FROM lineitem, (VALUES (0), (1)) AS g(i) WHERE i = 0 OR l_linestatus = 'F'
    """,
)
def explode_nested_path(t):
    """Grounds of the owner of every statistic: an array inside an array."""
    flags = F.when(F.col("s.name") == "wins", "A").when(F.col("s.name") == "draws", "N").otherwise("R")
    return explode_chain(standins.club_stats(t), [("stats", "s"), ("s.owner.grounds", "g")]).select(
        flags.alias("flag"),
        F.col("s.owner.club.id").cast("bigint").alias("club_id"),
        F.col("g.id").cast("bigint").alias("stadium_id"),
        F.col("s.value").alias("value"),
    )


@query(
    "NST-3 NST-4",
    """
    SELECT strftime(o_orderdate, '%B') AS month, CAST(left(o_orderpriority, 1) AS BIGINT) AS award_id,
           substr(o_orderpriority, 3) AS name
    FROM orders
    """,
)
def stack_columns(t):
    """One column per month to rows, with the month kept."""
    rows = stack_array_columns(standins.month_award(t), standins.MONTHS, "aw", label="month")
    return rows.select(
        "month", F.col("aw.awardTypeId").cast("bigint").alias("award_id"), F.col("aw.award").alias("name")
    )


@query(
    "NST-4",
    """
    SELECT o_orderkey, o_custkey + i AS member FROM orders, (VALUES (0), (1), (2)) AS g(i)
    WHERE i < 2 OR o_orderstatus = 'F'
    """,
)
def flatten_lists(t):
    """Arrays of arrays to rows."""
    key = F.col("o_custkey")
    lists = F.array(
        F.array(key, key + 1), F.when(F.col("o_orderstatus") == "F", F.array(key + 2)).otherwise(F.slice(F.array(key), 1, 0))
    )
    return flatten_arrays(t.orders.select("o_orderkey", lists.alias("lists")), "lists", "member", keep=["o_orderkey"])


@query(
    "NST-5",
    "SELECT event_id, 'k' AS key, CAST(props->>'$.k' AS BIGINT) AS value FROM events",
)
def object_to_rows(t):
    """JSON objects with unknown keys to (key, value) rows."""
    objects = t.events.select("event_id", F.from_json("props", "MAP<STRING, BIGINT>").alias("props"))
    return map_to_rows(objects, "props", "key", "value", keep=["event_id"])


@query(
    "NST-5 NST-6",
    """
    SELECT l_orderkey AS match_id, club, s.name, s.value FROM
        (SELECT l_orderkey, l_linenumber, l_quantity, unnest([CAST(l_suppkey AS VARCHAR), '-1']) AS club FROM lineitem) d,
        LATERAL (SELECT * FROM (VALUES ('formation_used', 433.0::DOUBLE), ('fk_foul_lost', d.l_linenumber::DOUBLE),
                                       ('duel_lost', d.l_quantity)) AS v(name, value)) s
    """,
)
def match_objects_to_rows(t):
    """{club: {M: [{name, value}]}} to rows; a club with an empty list gives none."""
    rows = map_items_to_rows(standins.match_stats(t), "stats", "M", "club", "m", keep=["entity"])
    return star(rows, "m", keep=["entity", "club"]).select(
        F.col("entity.id").cast("bigint").alias("match_id"), "club", "name", "value"
    )
