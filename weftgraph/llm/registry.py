"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from weftgraph.llm import graph_queries, history_queries, leakage_queries, neighbours_queries, packing_queries, prose_queries, splitting_queries

MODULES = (graph_queries, splitting_queries, neighbours_queries, history_queries, packing_queries, leakage_queries, prose_queries)


def queries() -> dict[str, Callable]:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
