"""League documents derived row by row from the test tables.

Every frame has the declared shape of a source and grows with its table:
clubs are suppliers, players and managers are customers, statistics are line
items and events, matches and month awards are orders. No rows are grouped
here, so nothing is collected however skewed a key is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sportmart.functions import academic_year

# fixed values: names of the statistics in the derived documents
CLUB_NAMES = ["draws", "losses", "wins"]
PLAYER_NAMES = ["CLICK", "ERROR", "PURCHASE", "REFUND", "VIEW"]
MATCH_NAMES = ["duel_lost", "fk_foul_lost", "formation_used"]
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
]
CLUB_SEASONS = ["1999-00", "2000-01"]
LOAD_TIME = datetime(2024, 1, 1)


class Tables:
    """The test tables of one directory as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        # kept as an attribute, so footers and files are listed once per table
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        setattr(self, name, df)
        return df


def season_of(day: str) -> Column:
    return academic_year(F.col(day)).alias("season")


def seasons(t: Tables) -> DataFrame:
    """One row per academic year with orders or events: id 1998, label 1998/99."""
    labels = t.orders.select(season_of("o_orderdate")).union(t.events.select(season_of("ts"))).distinct()
    return labels.selectExpr("CAST(substring(season, 1, 4) AS BIGINT) AS id", "replace(season, '-', '/') AS label")


def club_info(t: Tables) -> DataFrame:
    """Two seasons per club; poorer clubs change their name in the second."""
    ground = """struct(
        CAST(s_suppkey * 10 + {i} AS DOUBLE) AS id, concat('Ground ', s_suppkey * 10 + {i}) AS name,
        s_acctbal * 10 AS capacity, concat('City ', s_nationkey) AS city,
        struct(s_acctbal / 100 AS latitude, -s_acctbal / 100 AS longitude) AS location)"""
    first, second = ground.format(i=0), ground.format(i=1)
    before, after = CLUB_SEASONS
    return t.supplier.selectExpr("*", f"explode(array('{before}', '{after}')) AS season").selectExpr(
        "CAST(s_suppkey AS DOUBLE) AS id",
        f"IF(s_acctbal < 1000 AND season = '{after}', concat(s_name, ' FC'), s_name) AS name",
        "struct(s_name AS name, concat('Club ', s_suppkey) AS shortName, concat('C', s_suppkey) AS abbr) AS club",
        f"""CASE WHEN s_acctbal < 0 THEN NULL
                 WHEN s_acctbal < 500 THEN slice(array({first}), 1, 0)
                 WHEN s_acctbal < 5000 THEN array({first})
                 ELSE array({first}, {second}) END AS grounds""",
        "season",
    )


def club_stats(t: Tables) -> DataFrame:
    """One envelope per line item: its return flag names the statistic.

    Line items of 50 pieces carry no club id; finished ones have two grounds.
    """
    name = "CASE l_returnflag WHEN 'A' THEN 'wins' WHEN 'N' THEN 'draws' ELSE 'losses' END"
    ground = "struct(CAST(l_suppkey * 10 + {i} AS DOUBLE) AS id)"
    first, second = ground.format(i=0), ground.format(i=1)
    return t.lineitem.select(
        F.expr(name).alias("entity"),
        F.expr(f"""array(struct({name} AS name, l_quantity AS value, struct(
            struct(IF(l_quantity < 50, CAST(l_suppkey AS DOUBLE), NULL) AS id) AS club,
            IF(l_linestatus = 'F', array({first}, {second}), array({first})) AS grounds) AS owner))""").alias("stats"),
        season_of("l_shipdate"),
    )


BIRTH_LABEL = "IF(c_acctbal >= 0, date_format(date_add(DATE '1960-01-01', CAST(c_custkey % 9000 AS INT)), 'd MMMM yyyy'), NULL)"
PERSON_NAME = "struct(split(c_name, '#')[0] AS first, split(c_name, '#')[1] AS last)"


def _country(listed: str) -> str:
    """Country struct of a customer, its code only under a condition."""
    return f"""struct(IF({listed}, concat('C', c_nationkey), NULL) AS isoCode, concat('NATION_', c_nationkey) AS country,
        IF(c_nationkey <> 7, concat('Nat', c_nationkey), NULL) AS demonym)"""


def manager_info(t: Tables) -> DataFrame:
    """Customers as managers of club key/2 for one to four seasons from 1996-97."""
    served = t.customer.selectExpr("*", "explode(sequence(1996, 1996 + c_nationkey % 4)) AS year")
    return served.selectExpr(
        "CAST(c_custkey AS DOUBLE) AS officialId",
        f"{PERSON_NAME} AS name",
        "struct(IF(c_mktsegment <> 'HOUSEHOLD', CAST(c_custkey div 2 AS DOUBLE), NULL) AS id) AS currentTeam",
        f"""struct(struct({BIRTH_LABEL} AS label) AS date,
                   {_country("c_mktsegment <> 'FURNITURE'")} AS country) AS birth""",
        "concat(year, '-', right(CAST(year + 1 AS STRING), 2)) AS season",
    )


def player_info(t: Tables) -> DataFrame:
    """Customers as players, listed in two seasons alike."""
    before, after = CLUB_SEASONS
    return t.customer.selectExpr(
        "CAST(c_custkey AS DOUBLE) AS playerId",
        """struct(left(c_mktsegment, 1) AS position, CAST(c_custkey % 99 AS DOUBLE) AS shirtNum,
                  IF(c_mktsegment <> 'BUILDING', concat(initcap(c_mktsegment), ' Lead/Wide Back'), NULL)
                      AS positionInfo) AS info""",
        f"{_country('c_acctbal <= 9000')} AS nationalTeam",
        f"{PERSON_NAME} AS name",
        f"struct(struct({BIRTH_LABEL} AS label) AS date) AS birth",
        f"explode(array('{before}', '{after}')) AS season",
    )


def player_stats(t: Tables) -> DataFrame:
    """One envelope per event; sign-ups name no club. Values are whole cents."""
    return t.events.select(
        F.col("event_type").alias("entity"),
        F.expr("""array(struct(event_type AS name, rint(value * 100) AS value, struct(
            CAST(user_id AS DOUBLE) AS playerId,
            struct(struct(IF(event_type <> 'signup', CAST(user_id % 20 AS DOUBLE), NULL) AS id) AS club) AS currentTeam
            ) AS owner))""").alias("stats"),
        season_of("ts"),
    )


def _related(key: str, promoted: str, plain: str) -> str:
    """Related content of an award: promotional and text, text only, or none."""
    text = f"struct('TEXT' AS type, concat('txt-', {key}) AS reference)"
    return f"""CASE WHEN {promoted} THEN array(struct('PROMO' AS type, concat('ref-', {key}) AS reference), {text})
                    WHEN {plain} THEN array({text}) END"""


def month_award(t: Tables) -> DataFrame:
    """One array column per month; an order is one award in its own month."""
    items = t.orders.select(
        F.expr(f"""struct(
            CAST(left(o_orderpriority, 1) AS DOUBLE) AS awardTypeId, substring(o_orderpriority, 3) AS award,
            struct(IF(o_orderstatus = 'F', CAST(o_custkey AS DOUBLE), NULL) AS playerId) AS player,
            struct(IF(o_orderstatus = 'O', CAST(o_custkey AS DOUBLE), NULL) AS officialId) AS official,
            {_related('o_orderkey', "o_orderstatus = 'F'", "o_orderstatus = 'O'")} AS relatedContent)""").alias("item"),
        F.expr("month(o_orderdate)").alias("month"),
        season_of("o_orderdate"),
    )
    return items.selectExpr(
        *[f"IF(month = {i}, array(item), NULL) AS {name}" for i, name in enumerate(MONTHS, start=1)], "season"
    )


def season_award(t: Tables) -> DataFrame:
    """Customers as holders of an award of their segment; id 5 also is a month award."""
    holder = "struct(IF({who}, CAST({key} AS DOUBLE), NULL) AS {field}) AS {name}"
    return t.customer.selectExpr(
        """CASE c_mktsegment WHEN 'BUILDING' THEN 5D WHEN 'MACHINERY' THEN 11D WHEN 'AUTOMOBILE' THEN 12D
                             WHEN 'HOUSEHOLD' THEN 13D WHEN 'FURNITURE' THEN 14D END AS awardTypeId""",
        "c_mktsegment AS award",
        holder.format(who="c_acctbal > 5000", key="c_custkey", field="playerId", name="player"),
        holder.format(who="c_acctbal BETWEEN 0 AND 5000", key="c_custkey", field="officialId", name="official"),
        holder.format(who="c_acctbal < 0", key="c_nationkey", field="id", name="apiTeam"),
        f"{_related('c_custkey', 'c_acctbal > 5000', 'c_acctbal >= 0')} AS relatedContent",
        f"IF(c_nationkey < 12, '{CLUB_SEASONS[0]}', '{CLUB_SEASONS[1]}') AS season",
    )


def award_documents(t: Tables) -> DataFrame:
    """Orders as combined award documents: month awards as a map, season awards as a list."""
    item = """array(struct(CAST(left(o_orderpriority, 1) AS DOUBLE) AS awardTypeId,
                           substring(o_orderpriority, 3) AS award, CAST(o_custkey AS DOUBLE) AS holder))"""
    return t.orders.select(
        F.expr(f"IF(o_orderstatus <> 'P', map(date_format(o_orderdate, 'MMMM'), {item}), NULL)").alias("monthAwards"),
        F.expr(f"IF(o_orderstatus = 'P', {item}, NULL)").alias("seasonAwards"),
        season_of("o_orderdate"),
    )


def kickoff_label() -> Column:
    """Kick-off text of an order: its date at minute key % 1440, London time."""
    minute = "CAST(o_orderkey % 1440 AS INT)"
    return F.expr(f"""concat(
        date_format(CAST(o_orderdate AS DATE), 'EEE d MMM yyyy'), ', ',
        lpad({minute} div 60, 2, '0'), ':', lpad({minute} % 60, 2, '0'),
        CASE o_orderstatus WHEN 'F' THEN ' BST' WHEN 'O' THEN ' GMT' ELSE '' END)""")


def match_info(t: Tables) -> DataFrame:
    """Orders as matches; pending ones have no away team and no clock."""
    home = "struct(struct(CAST(o_custkey AS DOUBLE) AS id) AS team, o_orderkey % 6 + 0.5D AS score)"
    away = "struct(struct(CAST(o_custkey + 1 AS DOUBLE) AS id) AS team, CAST(o_orderkey % 4 AS DOUBLE) AS score)"
    return t.orders.select(
        F.expr("CAST(o_orderkey AS DOUBLE)").alias("id"),
        F.expr(f"IF(o_orderstatus = 'P', array({home}), array({home}, {away}))").alias("teams"),
        F.struct(kickoff_label().alias("label")).alias("kickoff"),
        F.col("o_totalprice").alias("attendance"),
        F.expr("struct(CAST(o_orderkey % 38 + 1 AS DOUBLE) AS gameweek)").alias("gameweek"),
        F.expr("""struct(CASE o_orderstatus WHEN 'F' THEN concat('90 +', o_orderkey % 9, "'00") WHEN 'O' THEN '45' END
                         AS label, o_totalprice / 100 AS secs)""").alias("clock"),
        F.expr("struct(CAST(o_custkey * 10 AS DOUBLE) AS id)").alias("ground"),
        season_of("o_orderdate"),
    )


def match_stats(t: Tables) -> DataFrame:
    """One document per line item: a club with statistics, one without, one that did not play."""
    stat = "struct('{name}' AS name, CAST({value} AS DOUBLE) AS value, 'Todo: {name}' AS description)"
    items = ", ".join(
        stat.format(name=name, value=value)
        for name, value in (("formation_used", "433"), ("fk_foul_lost", "l_linenumber"), ("duel_lost", "l_quantity"))
    )
    guest = "(l_partkey + 100000000000)"
    team = "struct(struct(CAST({key} AS DOUBLE) AS id) AS team)"
    return t.lineitem.select(
        F.expr(f"""struct(CAST(l_orderkey AS DOUBLE) AS id,
            array({team.format(key='l_suppkey')}, {team.format(key=guest)}) AS teams)""").alias("entity"),
        F.expr(f"""map(CAST(l_suppkey AS STRING), struct(array({items}) AS M),
                       CAST({guest} AS STRING), struct(slice(array({items}), 1, 0) AS M),
                       '-1', struct(array({items}) AS M))""").alias("stats"),
        season_of("l_shipdate"),
    )


def sources(t: Tables) -> dict[str, DataFrame]:
    """All source frames by name."""
    makers = (
        seasons, club_info, club_stats, player_info, player_stats, manager_info, month_award, season_award,
        match_info, match_stats,
    )
    return {maker.__name__: maker(t) for maker in makers}
