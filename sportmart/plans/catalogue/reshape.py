"""Long-to-wide queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.operators.nested import map_to_rows
from sportmart.operators.reshape import distinct_sorted, long_to_wide
from sportmart.plans.catalogue.registry import query
from sportmart.plans.standins import PLAYER_NAMES


def cents():
    """Event values as whole cents: sums are exact and far cheaper than decimals."""
    return F.expr("CAST(rint(value * 100) AS BIGINT)").alias("value")


@query(
    "AGG-1 JON-3 FLT-3 SCL-12",
    """
    SELECT s.s_suppkey AS club_id, s.s_name AS name, n.n_name AS nation,
           f.qty_A, f.qty_N, f.qty_R
    FROM (
        SELECT l_suppkey,
               sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qty_A,
               sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS qty_N,
               sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS qty_R
        FROM lineitem GROUP BY l_suppkey
    ) f
    JOIN supplier s ON s.s_suppkey = f.l_suppkey
    JOIN nation n ON n.n_nationkey = s.s_nationkey
    """,
)
def stat_pivot_sum(t):
    """Quantity per supplier and return flag, folded before the joins.

    Quantities are whole numbers, so sums of doubles are exact.
    """
    flags = ["A", "N", "R"]
    wide = long_to_wide(t.lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", flags)
    return (
        wide.join(t.supplier, wide.l_suppkey == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("club_id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("nation"),
            *[F.col(flag).alias(f"qty_{flag}") for flag in flags],
        )
    )


@query(
    "AGG-1 AGG-6 SRT-2",
    """
    SELECT user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'click') AS DOUBLE) AS click,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'error') AS DOUBLE) AS error,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS signup,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'view') AS DOUBLE) AS view
    FROM events GROUP BY user_id
    """,
)
def stat_pivot_discovered(t):
    """Columns named by the distinct statistic names in the data, sorted."""
    names = distinct_sorted(t.events, "event_type", limit=1000)
    long = t.events.select("user_id", "event_type", cents())
    wide = long_to_wide(long, ["user_id"], "event_type", "value", names)
    return wide.select("user_id", *[(F.col(name) / 100).alias(name) for name in names])


@query(
    "AGG-2 PRJ-7 SCL-10",
    """
    SELECT user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE upper(event_type) = 'CLICK') AS DOUBLE) AS CLICK,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE upper(event_type) = 'ERROR') AS DOUBLE) AS ERROR,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE upper(event_type) = 'PURCHASE') AS DOUBLE) AS PURCHASE,
           CAST(NULL AS DOUBLE) AS REFUND,
           CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE upper(event_type) = 'VIEW') AS DOUBLE) AS VIEW
    FROM events GROUP BY user_id
    """,
)
def stat_pivot_fixed_upper(t):
    """Upper-cased names against a fixed list: one is absent, one unlisted."""
    long = t.events.select("user_id", F.upper("event_type").alias("stat"), cents())
    wide = long_to_wide(long, ["user_id"], "stat", "value", PLAYER_NAMES)
    return wide.select("user_id", *[(F.col(name) / 100).alias(name) for name in PLAYER_NAMES])


@query(
    "AGG-3 NST-5 FLT-4",
    """
    SELECT user_id,
           max(value) FILTER (WHERE event_type = 'click') AS click,
           max(value) FILTER (WHERE event_type = 'view') AS view
    FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id
    """,
)
def stat_pivot_first(t):
    """Dynamic-key objects to rows, then the greatest value per listed name."""
    objects = t.events.select("user_id", F.create_map("event_type", "value").alias("stats"))
    long = map_to_rows(objects, "stats", "stat", "value", keep=["user_id"])
    return long_to_wide(long, ["user_id"], "stat", "value", ["click", "view"], agg="max", listed_only=True)


WIDE_NAMES = [f"k{i}" for i in range(100)]


@query(
    "AGG-1 AGG-3 PRJ-8",
    "SELECT user_id, "
    + ", ".join(
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE props->>'$.k' = '{i}') AS DOUBLE) AS k{i}"
        for i in range(50, 100)
    )
    + " FROM events GROUP BY user_id",
)
def stat_pivot_wide(t):
    """A hundred statistics at once, of which the latter half is selected by position."""
    long = t.events.select(
        "user_id",
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("stat"),
        cents(),
    )
    wide = long_to_wide(long, ["user_id"], "stat", "value", WIDE_NAMES)
    return wide.select("user_id", *[(F.col(name) / 100).alias(name) for name in wide.columns[51:]])


@query(
    "AGG-9 SRT-1",
    """
    SELECT CAST(week(o_orderdate) AS INTEGER) AS game_week, CAST(count(*) AS BIGINT) AS matches
    FROM orders GROUP BY 1
    """,
)
def weekly_counts(t):
    """Matches per week, sorted for presentation."""
    return (
        t.orders.groupBy(F.weekofyear("o_orderdate").alias("game_week"))
        .agg(F.count(F.lit(1)).alias("matches"))
        .orderBy("game_week")
    )


@query(
    "AGG-6 SRT-2",
    "SELECT DISTINCT event_type AS stat_name FROM events",
)
def stat_names(t):
    """Distinct statistic names, sorted."""
    return t.events.select(F.col("event_type").alias("stat_name")).distinct().orderBy("stat_name")


@query(
    "AGG-7",
    """
    SELECT 'events' AS dataset, CAST(count(*) AS BIGINT) AS n, count(*) > 0 AS has_rows FROM events
    UNION ALL
    SELECT 'orders', CAST(count(*) AS BIGINT), count(*) > 0 FROM orders WHERE o_totalprice < 0
    """,
)
def row_counts(t):
    """Row counts and the emptiness they imply."""
    def count(name, df):
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("dataset"), "n", (F.col("n") > 0).alias("has_rows")
        )

    return count("events", t.events).union(count("orders", t.orders.where("o_totalprice < 0")))
