"""Reshaping of landed listing pages and award documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sportmart.functions.text import last_segment
from sportmart.operators.nested import array_columns, map_to_rows, stack_array_columns
from sportmart.session import settings, staged

ANCHOR = r"(?i)<a\s[^>]*>"
HREF = r"""(?i)\shref\s*=\s*["']?([^"'\s>]+)"""


def flatten_pages(pages: DataFrame, content: str = "content", keep: Sequence[str] = ()) -> DataFrame:
    """Entries of all pages of a listing; pages without entries give none.

    Struct entries become columns, other entries a column named as ``content``.
    """
    entries = pages.select(*keep, F.explode(content).alias(content))
    if isinstance(entries.schema[content].dataType, T.StructType):
        return entries.select(*keep, f"{content}.*")
    return entries


def envelope(pages: DataFrame, entity: str = "entity", items: str = "stats.content", keep: Sequence[str] = ()) -> DataFrame:
    """``{entity, stats: {content: [...]}}`` pages to ``{entity, stats}`` rows."""
    return pages.select(*keep, F.col(entity).alias("entity"), F.col(items).alias("stats"))


def link_codes(html: DataFrame, column: str, classes: Sequence[str] | None = None) -> DataFrame:
    """Distinct last URL segments of the links in a page column.

    ``classes`` keeps links that carry at least one of the class names.
    """
    tags = html.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(ANCHOR), F.lit(0))).alias("tag"))
    if classes is not None:
        names = F.split(F.regexp_extract("tag", r"""(?i)\sclass\s*=\s*["']([^"']*)["']""", 1), r"\s+")
        tags = tags.where(F.arrays_overlap(names, F.array(*[F.lit(name) for name in classes])))
    href = F.regexp_extract("tag", HREF, 1)
    return tags.where(href != "").select(last_segment(href).alias("code")).distinct()


def award_rows(month_award: DataFrame, keep: Sequence[str] = (), month: str = "month") -> DataFrame:
    """Month awards as rows (month, award_month).

    The months are either the keys of a map column ``awards`` or one array
    column each.
    """
    if "awards" in month_award.columns and isinstance(month_award.schema["awards"].dataType, T.MapType):
        entries = map_to_rows(month_award, "awards", month, "_list", keep)
        return entries.select(*keep, month, F.explode("_list").alias("award_month"))
    months = [name for name in array_columns(month_award) if name not in keep]
    return stack_array_columns(month_award, months, "award_month", label=month, keep=keep)


def split_awards(documents: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One award document to (month_award, season_award) source frames."""
    months = documents.select(*keep, F.col("monthAwards").alias("awards"))
    seasons = documents.select(*keep, F.explode("seasonAwards").alias("_item")).select(*keep, "_item.*")
    return months, seasons


def related_references(awards: DataFrame, related: str, kind: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """References of the related content, optionally of one type only.

    Awards without related content give none.
    """
    wanted: Column = F.col(related)
    if kind is not None:
        wanted = F.filter(wanted, lambda item: item["type"] == kind)
    return awards.select(*keep, F.explode(wanted).alias("_ref")).select(
        *keep, F.col("_ref.reference").alias("reference")
    )


def documents_for_ids(ids: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """The landed documents whose id is in a listing; ids may repeat."""
    return documents.join(ids.select(key), key, "left_semi")


#: Spark injects a Bloom filter of the listing's ids into the scan of the documents: for any size of the documents, and for listings
#: up to so many bytes and ids.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "134217728",
}


def documents_of_large_listing(ids: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """``documents_for_ids`` for listings too large to broadcast: documents that a Bloom filter of the ids rules out are not shuffled.

    The filter is 16 MB at most, whatever the listing. Spark makes one only of a listing that a comparison has cut down, such as
    one of a season. The result is written to the shared folder, since the settings hold while the join runs.
    """
    with settings(documents.sparkSession, {**BLOOM, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        return staged(documents_for_ids(ids, documents, key), "listed")


def current_season(seasons: DataFrame, label: str | None = None) -> DataFrame:
    """The season of the academic year ``label``, or the last one."""
    if label is not None:
        return seasons.where(F.col("label") == label)
    last = seasons.agg(F.max("label").alias("label"))
    return seasons.join(last, "label", "left_semi").select(*seasons.columns)


def first_seasons(seasons: DataFrame, n: int, column: str = "label") -> DataFrame:
    """The first ``n`` seasons."""
    return seasons.orderBy(column).limit(n)
