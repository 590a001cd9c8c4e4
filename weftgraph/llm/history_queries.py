"""Queries on batches of extracted names against all names accepted before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm.history import NameIndex, with_concepts
from weftgraph.plans.lineage import cut, shared_folder
from weftgraph.sources.tables import table

#: The batch number of everything accepted before the first batch.
BEFORE = -1


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: the row with the least batch number of those delivered; rows without record_id are left out."""
    rows = table(spark, folder, "entity_batches", "record_id", "batch_no", "name").where("record_id IS NOT NULL")
    first = F.min(F.struct(F.coalesce("batch_no", F.lit((1 << 31) - 1)).alias("batch"), F.coalesce("name", F.lit("")).alias("name")))
    return rows.groupBy("record_id").agg(first.alias("r")).select(F.col("record_id").alias("record"), "r.batch", "r.name")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose name denotes a concept that was accepted before or brought by an earlier record.

    The history is indexed once; then batch after batch is checked against the index and added to it.
    """
    index = NameIndex(spark, f"{shared_folder(spark)}/names-{uuid.uuid4().hex}")
    history = table(spark, folder, "entities", "name").unionAll(table(spark, folder, "alias_table", "alias"))
    index.load(index.keys(history, "name", F.lit(BEFORE), F.lit(BEFORE)))
    records = cut(_records(spark, folder))
    own = cut(with_concepts(records, "name", ["record", "batch"]))
    least = own.groupBy("letters", "signs", "batch").agg(F.min("record").alias("record"))
    found = spark.createDataFrame([], "record_id bigint")
    for (number,) in sorted(records.select("batch").distinct().collect()):
        best = index.check(least.where(F.col("batch") == number)).withColumnsRenamed({"batch": "b", "record": "r"})
        batch = own.where(F.col("batch") == number)
        earlier = F.struct("b", "r") < F.struct(F.col("batch").cast("bigint"), "record")
        known = batch.join(best, ["letters", "signs"]).where(earlier)
        found = found.unionAll(known.select(F.col("record").alias("record_id")))
    return found


QUERIES = {"p5_found": p5_found}
#: Letters and signs of a column ``name``, for names that have a letter or digit.
_CONCEPT = """
  SELECT DISTINCT * EXCLUDE (name, plain, l), CASE WHEN plain LIKE '%s' AND l NOT LIKE '%ss' AND length(l) > 3 THEN left(l, length(l) - 1) ELSE l END AS letters,
    regexp_replace(plain, '[^0-9+%#]', '', 'g') AS signs
  FROM (
    SELECT *, regexp_replace(plain, '[^a-z]', '', 'g') AS l
    FROM (SELECT *, regexp_replace(strip_accents(lower(name)), '[^a-z0-9+%#]', '', 'g') AS plain FROM {table})
  ) WHERE regexp_matches(plain, '[a-z0-9]') AND lower(trim(name)) <> 'n/a'"""

ORACLES = {
    "p5_found": f"""
        WITH history AS (SELECT name FROM entities UNION ALL SELECT alias FROM alias_table),
        records AS (SELECT record_id, min(batch_no) AS batch, first(name) AS name FROM entity_batches WHERE record_id IS NOT NULL GROUP BY record_id),
        old AS ({_CONCEPT.format(table="history")}), own AS ({_CONCEPT.format(table="records")}),
        accepted AS (
          SELECT letters, signs, -1 AS batch, CAST(-1 AS BIGINT) AS record_id FROM old
          UNION ALL SELECT letters, signs, batch, record_id FROM own
        )
        SELECT r.record_id FROM own AS r WHERE EXISTS (
          SELECT 1 FROM accepted AS a WHERE a.signs = r.signs AND abs(length(a.letters) - length(r.letters)) <= 2
            AND (a.batch < r.batch OR (a.batch = r.batch AND a.record_id < r.record_id)) AND levenshtein(a.letters, r.letters) <= 2
        )""",
}
