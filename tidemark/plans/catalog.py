"""All queries and their SQL counterparts, gathered from the modules of this package."""

from __future__ import annotations

from tidemark.plans import loading_queries, mart_queries, quality_queries, star_queries, typing_queries, warehouse_queries, writer_queries

_MODULES = (loading_queries, typing_queries, star_queries, mart_queries, quality_queries, warehouse_queries, writer_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
