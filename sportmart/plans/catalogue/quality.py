"""Check suites, freshness and lineage over whole tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.operators.audit import freshness, lineage
from sportmart.operators.quality import Suite, null_counts, run_suites, type_names
from sportmart.plans import standins
from sportmart.plans.catalogue import models
from sportmart.plans.catalogue.registry import QUERIES, query, season_sql
from sportmart.plans.load import TARGETS, build_tables
from sportmart.plans.standins import CLUB_NAMES, MATCH_NAMES, PLAYER_NAMES
from sportmart.plans.suites import raw_suite, table_suite
from sportmart.schemas import with_statistics


@query(
    "DQ-2 AGG-8",
    """
    SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NULL) AS null_count, count(*) AS element_count
    FROM orders
    UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'P'), count(*) FROM orders
    UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice < 50000), count(*) FROM orders
    """,
)
def dq_null_counts(t):
    """Nulls of several columns in one pass."""
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
    )
    return null_counts(rows)


@query(
    "DQ-2",
    """
    SELECT dataset, 'not_null' AS "check", col AS "column", bad = 0 AS passed, bad AS unexpected_count,
           n AS element_count, detail
    FROM (
        SELECT 'orders' AS dataset, 'o_orderkey' AS col, 0::BIGINT AS bad, count(*) AS n, '' AS detail FROM orders
        UNION ALL SELECT 'orders', 'winner', 1, count(*), 'column is missing' FROM orders
        UNION ALL SELECT 'events', 'value', count(*) FILTER (WHERE event_type = 'error'), count(*), '' FROM events)
    """,
)
def dq_not_null(t):
    events = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return run_suites(
        [Suite("orders", t.orders).not_null(["o_orderkey", "winner"]), Suite("events", events).not_null(["value"])]
    )


@query(
    "DQ-1 DQ-3 DQ-4",
    """
    SELECT 'customer' AS dataset, v."check", v.col AS "column", v.bad = 0 AS passed, v.bad::BIGINT AS unexpected_count,
           c.n AS element_count, v.detail
    FROM (SELECT count(*) AS n FROM customer) c,
         (VALUES ('column_exists', 'c_name', 0, ''), ('column_exists', 'c_phone', 1, 'column is missing'),
                 ('any_column_exists', 'c_phone,c_name', 0, 'found: c_name'),
                 ('any_column_exists', 'c_phone,c_fax', 1, 'found: '),
                 ('column_set', '*', 4,
                  'missing: c_fax,c_phone; unexpected: c_acctbal,c_mktsegment')) AS v("check", col, bad, detail)
    """,
)
def dq_columns(t):
    """Mandatory, alternative and exact column sets."""
    suite = (
        Suite("customer", t.customer)
        .columns_exist(["c_name", "c_phone"])
        .any_column_exists(["c_phone", "c_name"])
        .any_column_exists(["c_phone", "c_fax"])
        .column_set(["c_custkey", "c_name", "c_nationkey", "c_phone", "c_fax"])
    )
    return suite.results()


@query(
    "DQ-5 SCL-15",
    """
    SELECT v.dataset, 'column_type' AS "check", v.col AS "column", v.bad = 0 AS passed,
           v.bad::BIGINT AS unexpected_count, c.n AS element_count, v.detail
    FROM (SELECT count(*) AS n FROM orders) c,
         (VALUES ('loose', 'o_orderkey', 0, ''), ('loose', 'o_totalprice', 0, ''),
                 ('loose', 'o_orderdate', 1, 'timestamp_ntz for date'), ('loose', 'o_winner', 1, 'column is missing'),
                 ('strict', 'o_totalprice', 1, 'decimal(12,2) for decimal(10,0)'),
                 ('types', 'LongType,DecimalType,TimestampNTZType', 0, '')) AS v(dataset, col, bad, detail)
    """,
)
def dq_types(t):
    """Types by name, with and without type parameters."""
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderdate")
    wanted = [
        ("o_orderkey", "bigint"), ("o_totalprice", "decimal(10,0)"), ("o_orderdate", "date"), ("o_winner", "string"),
    ]
    names = Suite("types", rows)
    names.any_column_exists(["o_orderkey"])
    simplified = names.results().select(
        "dataset", F.lit("column_type").alias("check"), F.lit(",".join(type_names(rows.schema))).alias("column"),
        "passed", "unexpected_count", "element_count", F.lit("").alias("detail"),
    )
    suites = [Suite("loose", rows).column_types(wanted), Suite("strict", rows).column_types(wanted[1:2], strict=True)]
    return run_suites(suites).unionByName(simplified)


@query(
    "DQ-6",
    """
    SELECT 'player_info' AS dataset, 'nested_exists' AS "check", v.col AS "column", v.bad = 0 AS passed,
           v.bad AS unexpected_count, v.n AS element_count, v.detail
    FROM (
        SELECT 'nationalTeam.isoCode' AS col, 2 * count(*) FILTER (WHERE c_acctbal > 9000) AS bad, 2 * count(*) AS n,
               '' AS detail FROM customer
        UNION ALL SELECT 'birth.date.label', 2 * count(*) FILTER (WHERE c_acctbal < 0), 2 * count(*), '' FROM customer
        UNION ALL SELECT 'birth.place', 1, 2 * count(*), 'path is missing' FROM customer) v
    """,
)
def dq_nested(t):
    suite = (
        Suite("player_info", standins.player_info(t))
        .nested_exists("nationalTeam", "isoCode")
        .nested_exists("birth", "date.label")
        .nested_exists("birth", "place")
    )
    return suite.results()


@query(
    "DQ-7",
    """
    SELECT dataset, "check", CAST(count(*) AS BIGINT) AS n, CAST(sum(unexpected) AS BIGINT) AS unexpected, elements FROM (
        SELECT dataset, 'column_exists' AS "check", 0 AS unexpected, e.elements FROM
            (VALUES ('seasons', 2), ('club_info', 4), ('club_stats', 2), ('player_info', 5), ('player_stats', 2), ('manager_info', 3),
                    ('season_award', 5), ('match_info', 6)) AS m(dataset, k),
            LATERAL (SELECT unnest(range(k))) AS r(i),
            LATERAL (SELECT CASE dataset
                WHEN 'seasons' THEN (SELECT count(*) FROM (SELECT """ + season_sql("o_orderdate") + """ FROM orders
                                     UNION SELECT """ + season_sql("ts") + """ FROM events))
                WHEN 'club_info' THEN (SELECT 2 * count(*) FROM supplier)
                WHEN 'club_stats' THEN (SELECT count(*) FROM lineitem)
                WHEN 'player_info' THEN (SELECT 2 * count(*) FROM customer)
                WHEN 'player_stats' THEN (SELECT count(*) FROM events)
                WHEN 'manager_info' THEN (SELECT CAST(sum(1 + c_nationkey % 4) AS BIGINT) FROM customer)
                WHEN 'season_award' THEN (SELECT count(*) FROM customer)
                ELSE (SELECT count(*) FROM orders) END AS elements) e
        UNION ALL
        SELECT 'club_info', 'not_null', 2 * count(*) FILTER (WHERE s_acctbal < 0), 2 * count(*) FROM supplier
        UNION ALL SELECT 'club_stats', 'not_null', 0, count(*) FROM lineitem
        UNION ALL
        SELECT 'month_award', 'not_null', count(*) FILTER (WHERE month(o_orderdate) <> m), count(*)
        FROM orders, (SELECT unnest(range(1, 13)) AS m) GROUP BY m)
    GROUP BY ALL
    """,
)
def dq_raw_suite(t):
    """The suite over the sources, summed per dataset and kind of check."""
    results = run_suites([raw_suite(name, df) for name, df in standins.sources(t).items()])
    return results.groupBy("dataset", "check").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("unexpected_count").alias("unexpected"),
        F.max("element_count").alias("elements"),
    )


# the SQL below is put together from the queries of that module
assert models


def _built_sql() -> str:
    """Checks and rows of the 13 tables, from the SQL of their own queries."""
    counted = [
        f"SELECT '{name}' AS dataset, {len(columns) + 1} AS checks, (SELECT count(*) FROM ({QUERIES[name].sql})) AS elements"
        for name, columns in _table_columns().items()
    ]
    return " UNION ALL ".join(counted)


def _table_columns():
    names = {"fct_club_stat": CLUB_NAMES, "fct_player_stat": PLAYER_NAMES, "fct_match_stat": MATCH_NAMES}
    return {name: with_statistics(name, names.get(name, [])) for name in TARGETS}


@query(
    "DQ-8 DQ-4 DQ-5",
    f"""
    SELECT dataset, dataset <> 'dim_club' AS passed, CAST(checks AS BIGINT) AS checks, elements FROM ({_built_sql()})
    """,
)
def dq_table_suite(t):
    """The suite over the 13 built tables; one of them carries a column too many."""
    tables = build_tables(standins.sources(t), CLUB_NAMES, PLAYER_NAMES, MATCH_NAMES)
    tables["dim_club"] = tables["dim_club"].withColumn("founded", F.lit(1900))
    columns = _table_columns()
    results = run_suites([table_suite(name, df, columns[name]) for name, df in tables.items()])
    return results.groupBy("dataset").agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.max("element_count").alias("elements"),
    )


NOW = datetime(2024, 1, 30, 23, 59)


@query(
    "RAM-1",
    """
    SELECT w."table", e.last_ts, coalesce(e.last_ts >= TIMESTAMP '2024-01-30 22:59:00', false) AS fresh
    FROM (VALUES ('click'), ('error'), ('refund'), ('view')) AS w("table")
    LEFT JOIN (SELECT event_type AS "table", max(ts) AS last_ts FROM events GROUP BY 1) e USING ("table")
    """,
)
def freshness_of_tables(t):
    """Event types as tables: which had an operation within the hour before a fixed time."""
    audit = t.events.select(F.col("event_type").alias("table"), "ts")
    return freshness(audit, ["click", "error", "refund", "view"], NOW, timedelta(hours=1))


@query(
    "RAM-3",
    """
    SELECT m.source, m."table", e.operations, e.last_ts FROM
        (VALUES ('clicks.json', 'click'), ('views.json', 'view'), ('clicks.json', 'view')) AS m(source, "table")
    JOIN (SELECT event_type AS "table", count(*) AS operations, max(ts) AS last_ts FROM events GROUP BY 1) e
        USING ("table")
    """,
)
def lineage_of_operations(t):
    """Operations per table beside the sources that feed it."""
    inputs = {"click": ["clicks.json"], "view": ["views.json", "clicks.json"]}
    operations = t.events.groupBy(F.col("event_type").alias("table")).agg(
        F.count(F.lit(1)).alias("operations"), F.max("ts").alias("last_ts")
    )
    return lineage(t.spark, inputs).join(operations, "table").select("source", "table", "operations", "last_ts")


def table_lineage(spark):
    """Sources of the 13 tables."""
    return lineage(spark, {name: target.sources for name, target in TARGETS.items()})


def _lineage_sql() -> str:
    rows = {
        "seasons": f"(SELECT count(*) FROM {models.SEASON_IDS_SQL})", "club_info": "(SELECT 2 * count(*) FROM supplier)",
        "club_stats": "(SELECT count(*) FROM lineitem)", "match_stats": "(SELECT count(*) FROM lineitem)",
        "player_info": "(SELECT 2 * count(*) FROM customer)", "player_stats": "(SELECT count(*) FROM events)",
        "manager_info": "(SELECT CAST(sum(1 + c_nationkey % 4) AS BIGINT) FROM customer)",
        "month_award": "(SELECT count(*) FROM orders)", "season_award": "(SELECT count(*) FROM customer)",
        "match_info": "(SELECT count(*) FROM orders)",
    }
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{name}' AS \"table\", {rows[source]} AS documents"
        for name, target in TARGETS.items() for source in target.sources
    )


@query("RAM-3", _lineage_sql())
def lineage_of_tables(t):
    """The sources of the 13 tables, with the number of their documents."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("documents")).select(F.lit(name).alias("source"), "documents")
        for name, df in standins.sources(t).items()
    ]
    return table_lineage(t.spark).join(reduce(DataFrame.union, counts), "source").select("source", "table", "documents")
