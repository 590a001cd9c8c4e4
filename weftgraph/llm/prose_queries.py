"""Queries on the quality of documents' texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm.prose import text_statistics
from weftgraph.plans.lineage import spread
from weftgraph.sources.tables import table


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and nearest profile of every document."""
    return text_statistics(spread(table(spark, folder, "documents", "doc_id", "text")), table(spark, folder, "common_words"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are not natural prose."""
    return p9_statistics(spark, folder).where("profile <> 'prose'").select("doc_id")


QUERIES = {"p9_found": p9_found, "p9_statistics": p9_statistics}
ORACLES: dict[str, str] = {}
