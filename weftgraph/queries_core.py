"""Queries on the core's own operators for records that are new or changed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weftgraph.operators.incremental import Ledger
from weftgraph.operators.intake import pending
from weftgraph.plans.lineage import shared_folder
from weftgraph.sources.tables import table


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Papers to process now: the output of a run of a ledger that knows what the manifest shows as finished."""
    ledger = Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    manifest = table(spark, folder, "manifest", "arxiv_id", "run_no", "content_hash", "status", "recorded_at", "loaded_at")
    number = pending(table(spark, folder, "corpus_scan", "arxiv_id", "content_hash", "scanned_at"), manifest, ledger)
    return ledger.output("arxiv_id string", [] if number is None else [number])


QUERIES = {"p6_found": p6_found}

ORACLES = {
    "p6_found": """
        WITH scan AS (
          SELECT arxiv_id, lower(trim(content_hash)) AS h,
                 row_number() OVER (PARTITION BY arxiv_id ORDER BY scanned_at DESC NULLS LAST, lower(trim(content_hash)) DESC) AS rn
          FROM corpus_scan WHERE arxiv_id IS NOT NULL AND trim(content_hash) <> ''
        ), seen AS (
          SELECT arxiv_id, lower(trim(content_hash)) AS h, lower(trim(status)) AS s,
                 row_number() OVER (PARTITION BY arxiv_id ORDER BY recorded_at DESC NULLS LAST, loaded_at DESC NULLS LAST, run_no DESC NULLS LAST) AS rn
          FROM manifest WHERE arxiv_id IS NOT NULL
        )
        SELECT scan.arxiv_id FROM scan LEFT JOIN (SELECT * FROM seen WHERE rn = 1) AS m ON m.arxiv_id = scan.arxiv_id
        WHERE scan.rn = 1 AND NOT coalesce(m.h = scan.h AND m.s = 'indexed', false)""",
}
