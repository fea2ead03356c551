"""Ingestion reshaping over the whole page, document and conversation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sportmart.functions import last_segment
from sportmart.operators.nested import explode_path
from sportmart.operators.pages import (
    award_rows,
    documents_for_ids,
    documents_of_large_listing,
    envelope,
    flatten_pages,
    link_codes,
    related_references,
    split_awards,
)
from sportmart.plans import standins
from sportmart.plans.catalogue.registry import query, season_sql


@query(
    "ING-1 NST-4",
    """
    SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''
    """,
)
def pages_flatten(t):
    """Documents as pages whose entries are their lines; blank lines are no entries."""
    lines = F.filter(F.split("text", "\n"), lambda line: line != "")
    return flatten_pages(t.documents.select("doc_id", lines.alias("line")), "line", keep=["doc_id"])


@query("ING-1", "SELECT conv_id, turn, role, length(text) AS chars FROM conversations")
def pages_flatten_structs(t):
    """Pages with struct entries: the fields become columns."""
    entry = F.struct("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))
    return flatten_pages(t.conversations.select(F.array(entry).alias("content")))


@query(
    "ING-2 NST-1",
    """
    SELECT event_type AS entity, user_id AS player_id, round(value * 100) AS value FROM events
    """,
)
def envelope_projection(t):
    """{entity, stats: {content}} pages to {entity, stats} and on to rows."""
    pages = standins.player_stats(t).select("entity", F.struct(F.col("stats").alias("content")).alias("stats"))
    rows = explode_path(envelope(pages), "stats", "s", keep=["entity"])
    return rows.select(
        "entity", F.col("s.owner.playerId").cast("bigint").alias("player_id"), F.col("s.value").alias("value")
    )


def codes_sql(html: str, where: str = "true") -> str:
    """Codes of the links in a page expression, in SQL."""
    return f"""
    SELECT DISTINCT list_extract(string_split(string_split(href, '?')[1], '/'), -1) AS code FROM (
        SELECT tag, regexp_extract(tag, '(?i)\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1) AS href
        FROM (SELECT unnest(regexp_extract_all({html}, '(?i)<a\\s[^>]*>')) AS tag FROM pages))
    WHERE href <> '' AND {where}
    """


@query("ING-3 SCL-13 SET-5", codes_sql("html"))
def link_codes_of_pages(t):
    """Codes that the pages link to."""
    return link_codes(t.pages, "html")


CLASSED_SQL = """CASE page_id % 3 WHEN 0 THEN replace(html, '<a href', '<a class="top link" href')
    WHEN 1 THEN replace(html, '<a href', '<a title="x" class="more" href') ELSE html END"""


@query("ING-3", codes_sql(CLASSED_SQL, """regexp_matches(tag, '(?i)\\sclass="(top link|more)"')"""))
def link_codes_by_class(t):
    """Codes of the links that carry one of two classes, which two thirds of the pages have."""
    html = F.expr(CLASSED_SQL)
    return link_codes(t.pages.select(html.alias("html")), "html", ["top", "more"])


@query(
    "SCL-13",
    "SELECT page_id, list_extract(string_split(string_split(url, '?')[1], '/'), -1) AS code FROM pages",
)
def url_codes(t):
    return t.pages.select("page_id", last_segment(F.col("url")).alias("code"))


@query(
    "ING-4 FLT-6",
    """
    SELECT 'month' AS type, 'ref-' || o_orderkey AS reference FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'season', 'ref-' || c_custkey FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT 'season', 'txt-' || c_custkey FROM customer WHERE c_acctbal >= 0
    """,
)
def related_refs(t):
    """Promotional content of month awards, all content of season awards."""
    month = related_references(award_rows(standins.month_award(t)), "award_month.relatedContent", "PROMO")
    season = related_references(standins.season_award(t), "relatedContent")
    return month.select(F.lit("month").alias("type"), "reference").union(
        season.select(F.lit("season"), "reference")
    )


@query(
    "ING-5 NST-3",
    f"""
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'season' ELSE 'month' END AS type, {season_sql('o_orderdate')} AS season,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%B') END AS month, o_custkey AS holder,
           substr(o_orderpriority, 3) AS award
    FROM orders
    """,
)
def award_split(t):
    """Combined award documents into month awards and season awards."""
    months, seasons = split_awards(standins.award_documents(t), keep=["season"])
    month_rows = award_rows(months, keep=["season"]).select(
        F.lit("month").alias("type"), "season", "month",
        F.col("award_month.holder").cast("bigint").alias("holder"), F.col("award_month.award").alias("award"),
    )
    season_rows = seasons.select(
        F.lit("season").alias("type"), "season", F.lit(None).cast("string").alias("month"),
        F.col("holder").cast("bigint").alias("holder"), "award",
    )
    return month_rows.union(season_rows)


@query(
    "ING-6",
    """
    SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
    """,
)
def documents_of_listing(t):
    """Documents whose id is in a listing."""
    listing = t.labels.where("quality = 1")
    return documents_for_ids(listing, t.documents, "doc_id").select("doc_id", "lang", "n_chars")


@query(
    "ING-6 JON-7 JON-8",
    """
    SELECT l_orderkey AS match_id, l_linenumber AS line, l_quantity AS value FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 250000)
    """,
)
def documents_of_filtered_listing(t):
    """Statistics of the matches in a listing that is joined by shuffle: a Bloom filter of its ids cuts what is shuffled."""
    listing = t.orders.where("o_totalprice > 250000").select(F.col("o_orderkey").alias("match_id"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("value")
    )
    return documents_of_large_listing(listing, lines, "match_id").select("match_id", "line", "value")
