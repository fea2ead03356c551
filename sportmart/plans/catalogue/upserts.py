"""Upsert queries: targets and sources come from the same tables.

Changed rows are chosen by attributes, new rows get keys no target row has.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sportmart.operators.audit import audit_row
from sportmart.operators.sets import latest_per_key
from sportmart.operators.upsert import single_per_key, upsert, upsert_counts
from sportmart.plans import dims, facts, standins
from sportmart.plans.catalogue.models import BRIDGE_SQL
from sportmart.plans.catalogue.registry import query, season_start_sql
from sportmart.plans.load import TARGETS
from sportmart.session import new_database
from sportmart.sources.frames import literal_rows
from sportmart.sources.tables import staged, upsert_table

COLUMNS = ["id", "name", "segment", "balance"]


def _customers(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def _changes(t):
    """Richer machinery customers, and debtors again under new negative keys."""
    rows = _customers(t)
    changed = rows.where("segment = 'MACHINERY'").withColumns(
        {"balance": F.col("balance") + 1, "name": F.concat("name", F.lit("*"))}
    )
    return changed.union(rows.where("balance < 0").withColumn("id", -F.col("id") - 1))


@query(
    "SNK-3 JON-9",
    """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '*' ELSE c_name END AS name,
           c_mktsegment AS segment, c_acctbal + CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS balance
    FROM customer
    UNION ALL SELECT -c_custkey - 1, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 0
    """,
)
def upsert_default(t):
    """Matched rows updated, new ones inserted, the rest as it was."""
    return upsert(_customers(t), _changes(t), ["id"])


@query(
    "SNK-3 RAM-2",
    """
    SELECT 'dim_player' AS "table", 'UPDATE' AS operation, TIMESTAMP '2024-01-01 00:00:00' AS ts,
           count(*) FILTER (WHERE c_acctbal < 0) AS rows_inserted,
           count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS rows_updated
    FROM customer
    """,
)
def upsert_audit(t):
    """The audit row of that upsert, counted by the job that writes the table."""
    table = f"{new_database(t.spark, 'customers')}.dim_player"
    upsert_table(_customers(t), table, ["id"], COLUMNS[1:])
    done = upsert_table(_changes(t), table, ["id"], COLUMNS[1:])
    counts = literal_rows(t.spark, [done], "rows_inserted BIGINT, rows_updated BIGINT")
    return audit_row(counts, "dim_player", datetime(2024, 1, 1))


@query(
    "SNK-3 RAM-2",
    """
    SELECT count(*) FILTER (WHERE c_acctbal < 0) AS rows_inserted,
           count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS rows_updated
    FROM customer
    """,
)
def upsert_row_counts(t):
    """What that upsert would insert and update, without writing."""
    return upsert_counts(_customers(t), _changes(t), ["id"])


@query(
    "SNK-3",
    """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '*' ELSE c_name END AS name,
           c_mktsegment AS segment, c_acctbal AS balance
    FROM customer
    UNION ALL SELECT -c_custkey - 1, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 0
    """,
)
def upsert_partial_cols(t):
    """Only the name is updated; the balance of a matched row stays."""
    return upsert(_customers(t), _changes(t), ["id"], ["name"])


@query(
    "SNK-3 FLT-1",
    """
    SELECT nullif(c_mktsegment, 'BUILDING') AS segment, c_custkey AS id, 'old' AS origin FROM customer
    WHERE c_mktsegment <> 'MACHINERY' OR c_acctbal < 0
    UNION ALL
    SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, c_custkey, 'new' FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal >= 0
    """,
)
def upsert_null_key(t):
    """Source rows with a null key part are inserted, even beside an equal target row."""
    rows = t.customer.select(
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_custkey").alias("id"),
        F.lit("old").alias("origin"), "c_acctbal",
    )
    source = rows.where("c_acctbal >= 0 AND (segment IS NULL OR segment = 'MACHINERY')")
    source = source.drop("c_acctbal").withColumn("origin", F.lit("new"))
    return upsert(rows.drop("c_acctbal"), source, ["segment", "id"])


@query(
    "SNK-3 JON-9",
    """
    WITH latest AS (
        SELECT user_id, value, event_type FROM
            (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
        WHERE r = 1)
    SELECT coalesce(c.c_custkey, l.user_id) AS id, coalesce(l.value, c.c_acctbal) AS value,
           coalesce(l.event_type, c.c_mktsegment) AS kind
    FROM (SELECT * FROM customer WHERE c_acctbal >= 0) c FULL OUTER JOIN latest l ON l.user_id = c.c_custkey
    """,
)
def upsert_latest(t):
    """Many source rows per key: the last event of a user counts."""
    target = t.customer.where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("kind")
    )
    source = t.events.select(F.col("user_id").alias("id"), "value", F.col("event_type").alias("kind"), "ts", "event_id")
    return upsert(target, source, ["id"], on_duplicate="latest", order=["ts", "event_id"])


@query(
    "SNK-3 MDL-11",
    """
    WITH w AS (
        SELECT user_id AS player_id, """ + season_start_sql("ts") + """ AS season_id,
               sum(round(value * 100)) FILTER (WHERE event_type = 'click') AS click,
               sum(round(value * 100)) FILTER (WHERE event_type = 'view') AS view,
               max(CASE WHEN event_type <> 'signup' THEN user_id % 20 END) AS club_id
        FROM events GROUP BY 1, 2)
    SELECT player_id, CASE WHEN click >= view THEN -1 ELSE club_id END AS club_id, season_id,
           click AS "CLICK", view AS "VIEW"
    FROM w
    """,
)
def upsert_player_fact(t):
    """The player fact matches by player and season: statistics change, the stored club stays."""
    target_spec = TARGETS["fct_player_stat"]
    names = ["CLICK", "VIEW"]
    fact = facts.fct_player_stat(standins.player_stats(t), standins.seasons(t), names)
    # sign-ups name no club, so a player can have two rows; as in the batch the greatest columns count
    keys = target_spec.keys(fact.columns)
    source = staged(single_per_key(fact, keys), "player-fact")
    # the stored fact: players with more clicks than views, another club, older statistics
    stored = source.where("CLICK >= VIEW").withColumns(
        {"club_id": F.lit(-1).cast("bigint"), **{name: F.lit(0.0) for name in names}}
    )
    return upsert(stored, source, keys, target_spec.update_cols(source.columns))


@query(
    "SNK-3 MDL-12",
    """
    SELECT DISTINCT * FROM (""" + BRIDGE_SQL + """) WHERE object_id IS NOT NULL
    UNION ALL SELECT * FROM (""" + BRIDGE_SQL + """) WHERE object_id IS NULL
    UNION ALL SELECT * FROM (""" + BRIDGE_SQL + """) WHERE object_id IS NULL AND award_id <= 2
    """,
)
def upsert_award_bridge(t):
    """A table whose columns are all keys: matches change nothing, the rest is inserted once, awards to nobody each time."""
    spec = TARGETS["fct_object_award"]
    given = facts.fct_object_award(
        standins.month_award(t), standins.season_award(t), standins.seasons(t)
    )
    given = staged(given, "awards-given")
    stored = latest_per_key(given.where("award_id <= 2"), spec.keys(given.columns), [])
    return upsert(stored, given, spec.keys(given.columns), spec.update_cols(given.columns), "any")


@query(
    "SNK-3 MDL-4",
    """
    SELECT s_suppkey AS club_id, s_name || CASE WHEN s_acctbal < 1000 THEN ' FC' ELSE '' END AS name,
           'Club ' || s_suppkey AS short_name, 'C' || s_suppkey AS abbr
    FROM supplier
    """,
)
def upsert_next_season(t):
    """The second season's clubs upserted into the first season's."""
    clubs = standins.club_info(t)
    first = dims.dim_club(clubs.where(F.col("season") == standins.CLUB_SEASONS[0]))
    second = dims.dim_club(clubs.where(F.col("season") == standins.CLUB_SEASONS[1]))
    spec = TARGETS["dim_club"]
    return upsert(first, second, spec.keys(first.columns), spec.update_cols(first.columns))
