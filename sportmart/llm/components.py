"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm.common import staged


#: Parts of the rows of one group; a group's list of parts is no longer than this.
SALTS = 1024


def with_least(rows: DataFrame, group: str, value: str, spread: str) -> DataFrame:
    """``rows`` and ``least``, the smallest ``value`` of their ``group``.

    The rows of a group are dealt out by ``spread``, and the minimum comes to each of its parts, so that no task gets all
    rows of a group that holds very many.
    """
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy(group, "__part").agg(F.min(value).alias("least"))
    least = parts.groupBy(group).agg(F.min("least").alias("least"), F.collect_set("__part").alias("__parts"))
    least = least.select(group, "least", F.explode("__parts").alias("__part"))
    return dealt.join(least, [group, "__part"]).drop("__part")


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest node among it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return with_least(both, "a", "b", "b").where("b > a").select(F.col("b").alias("a"), F.least("least", "a").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these. Edges lead from larger to smaller nodes."""
    moved = F.when(F.col("b") > F.col("least"), F.col("b")).otherwise(F.col("a"))
    return with_least(edges, "a", "b", "b").select(moved.alias("a"), F.col("least").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``edges(a, b)`` other than the roots.

    Each round is written to the shared folder. The stars shrink path lengths by half at least in
    practice; rounds go on until one changes nothing. Minima are folded before the shuffle and the edges of a node are
    dealt out in parts, so a node with very many neighbours is no large group.
    """
    spark = edges.sparkSession
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges = staged(spark, edges, "edges")
    state = None
    while True:
        facts = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(facts) == state or not facts[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(facts)
        edges = staged(spark, small_star(large_star(edges)).distinct(), "edges")
