"""All registered queries and their SQL."""

from __future__ import annotations

from checks import catalog_queries, event_queries, page_queries, scalar_queries, stream_queries

MODULES = [scalar_queries, page_queries, event_queries, catalog_queries, stream_queries]
flagship = catalog_queries.flagship


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
