"""Queries on similar entity vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm.neighbours import nearest
from weftgraph.plans.lineage import spread
from weftgraph.sources.tables import table


def p4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 most similar vectors of each, as far as their cosine is at least 0.85."""
    return nearest(spread(table(spark, folder, "vectors_entities", "vec_id", "vectors")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs with cosine of at least 0.85 of which one is among the other's 10 most similar."""
    pairs = p4_neighbours(spark, folder).select(
        F.least("vec_id", "neighbour").alias("vec_id_a"), F.greatest("vec_id", "neighbour").alias("vec_id_b")
    )
    return pairs.distinct()


QUERIES = {"p4_found": p4_found, "p4_neighbours": p4_neighbours}
#: No SQL: the search is approximate; it is tested against brute force.
ORACLES: dict[str, str] = {}
