"""Queries on documents that hold test items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm.leakage import leaked
from weftgraph.plans.lineage import spread
from weftgraph.sources.tables import table


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the items they reproduce, with the shares of the item's words."""
    return leaked(spread(table(spark, folder, "documents", "doc_id", "text")), table(spark, folder, "eval_items", "item_id", "text"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the items they reproduce."""
    return p8_leaks(spark, folder).select("doc_id", "item_id")


QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks}
ORACLES: dict[str, str] = {}
