"""All core queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from weftgraph import graph_queries, quality_queries, queries_core, table_queries, text_queries

MODULES = (queries_core, graph_queries, text_queries, quality_queries, table_queries)


def queries() -> dict[str, Callable]:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
