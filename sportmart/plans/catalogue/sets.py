"""Queries for unions, distinct and except."""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.functions import academic_year
from sportmart.operators.sets import align_to, except_distinct, latest_per_key, union_all, union_distinct, union_fill
from sportmart.plans.catalogue.registry import query, season_sql

PARTY = [("id", "bigint"), ("name", "string"), ("balance", "double"), ("segment", "string")]


def _parties(t):
    customers = t.customer.select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").cast("double").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = t.supplier.select(
        F.col("s_name").alias("NAME"), F.col("s_suppkey").cast("int").alias("id"), F.col("s_acctbal").alias("balance")
    )
    return customers, suppliers


@query(
    "SET-1 PRJ-11",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def union_aligned(t):
    """Frames with other column order, case and types, aligned to one schema."""
    return union_all(_parties(t), PARTY)


@query(
    "SET-2",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
    """,
)
def union_filled(t):
    """Union by name; what one side lacks is null."""
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return union_fill([customers, suppliers])


@query(
    "SET-3 AGG-5",
    """
    SELECT l_suppkey AS id, l_returnflag AS flag FROM lineitem
    UNION SELECT c_nationkey, left(c_mktsegment, 1) FROM customer
    """,
)
def union_deduplicated(t):
    """Set union: equal rows of both sides stay once."""
    left = t.lineitem.select(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("flag"))
    right = t.customer.select(F.col("c_nationkey").alias("id"), F.substring("c_mktsegment", 1, 1).alias("flag"))
    return union_distinct([left, right], [("id", "bigint"), ("flag", "string")])


@query(
    "SET-4",
    "SELECT o_custkey AS id FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0",
)
def except_rows(t):
    """Customers with orders, without those in debt."""
    ordered = t.orders.select(F.col("o_custkey").alias("id"))
    return except_distinct(ordered, t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id")))


@query(
    "SET-5 AGG-5",
    "SELECT DISTINCT p_brand AS code FROM part",
)
def distinct_codes(t):
    return t.part.select(F.col("p_brand").alias("code")).distinct()


@query(
    "SET-3 SNK-3",
    f"""
    SELECT user_id, event_id, value FROM
        (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
         FROM events)
    WHERE r = 1
    """,
)
def latest_rows(t):
    """The last event of every user, by an aggregate that combines before the shuffle."""
    return latest_per_key(
        t.events.select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"]
    ).drop("ts")


@query(
    "PRJ-11 PRJ-8",
    f"SELECT o_orderkey AS match_id, {season_sql('o_orderdate')} AS season, NULL::BIGINT AS club_id FROM orders",
)
def aligned_projection(t):
    """Columns of a target by name: cast where present, null where absent."""
    rows = t.orders.select(
        academic_year(F.col("o_orderdate")).alias("Season"), F.col("o_orderkey").cast("double").alias("MATCH_ID"), "o_custkey"
    )
    return align_to(rows, [("match_id", "bigint"), ("season", "string"), ("club_id", "bigint")])
