"""Queries on documents packed into containers of 4,096 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftgraph.llm.packing import packed
from weftgraph.plans.lineage import spread
from weftgraph.sources.tables import table


def p7_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every document, or of every piece of a document beyond the capacity."""
    return packed(spread(table(spark, folder, "documents", "doc_id", "text")))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that had to be split: those with a second piece."""
    return p7_packed(spark, folder).where("piece_no = 1").select("doc_id")


QUERIES = {"p7_found": p7_found, "p7_packed": p7_packed}
ORACLES: dict[str, str] = {}
