"""The query catalogue; importing it registers every query."""

from sportmart.plans.catalogue import landing, models, nested, pages, quality, reshape, scalars, sets, upserts
from sportmart.plans.catalogue.registry import QUERIES, Query

__all__ = [
    "QUERIES", "Query", "landing", "models", "nested", "pages", "quality", "reshape", "scalars", "sets", "upserts",
]
