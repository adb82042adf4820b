"""Every registered query of the engine, with the SQL that must give the same rows."""

from __future__ import annotations

from . import addresses, discovery, pages, reports, signals, tables, texts, upkeep  # noqa: F401 - each registers its queries
from .registry import QUERIES, SQL, Query

FLAGSHIP = "website_publishable"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
