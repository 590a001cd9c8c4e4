"""Intake as a stream: each micro-batch of papers is compared with the manifest and committed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftgraph.operators.incremental import Ledger
from weftgraph.plans.lineage import cut

MANIFEST = "arxiv_id string, content_hash string, previous_hash string, status string, batch_id bigint"


def changes(papers: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest rows of papers (arxiv_id, text) that are new or changed, or whose last run wasn't finished.

    The hash is sha-256 of the text. A paper with several texts in one batch counts with the greatest of its hashes.
    """
    hashed = papers.where("arxiv_id IS NOT NULL AND text IS NOT NULL").groupBy("arxiv_id").agg(F.max(F.sha2("text", 256)).alias("content_hash"))
    known = manifest.select("arxiv_id", F.col("content_hash").alias("known"), F.col("status").alias("last"))
    joined = hashed.join(known, "arxiv_id", "left")
    same = F.coalesce((F.col("known") == F.col("content_hash")) & (F.col("last") == "indexed"), F.lit(False))
    return joined.where(~same).select(
        "arxiv_id", "content_hash", F.col("known").alias("previous_hash"), F.when(F.col("known").isNull(), "new").otherwise("changed").alias("status")
    )


def stream_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest that the stream keeps in ``folder``: each paper's row of its latest batch."""
    rows = Ledger(spark, folder).output(MANIFEST)
    last = rows.groupBy("arxiv_id").agg(F.max_by(F.struct(*rows.columns), "batch_id").alias("last"))
    return last.select("last.*")


def stream_intake(spark: SparkSession, source: str, folder: str, checkpoint: str, handle=None) -> StreamingQuery:
    """Start the stream over Parquet files of (arxiv_id, text) in ``source``; its ledger is kept in ``folder``.

    A batch commits the rows of its changed papers, not the whole manifest, together with its number. ``handle`` gets these
    papers with their texts, and the number, before they are committed as indexed. A batch that is replayed after it was
    committed isn't handled again; one that failed before is handled a second time under the same number, so what ``handle``
    writes must be keyed by that number.
    """
    stream = spark.readStream.schema("arxiv_id string, text string").parquet(source)

    def commit(batch: DataFrame, number: int) -> None:
        ledger = Ledger(spark, folder)
        after, own = (ledger.runs() or [-1])[-1], spark.createDataFrame([(number, number + 1)], "lo bigint, hi bigint")
        if ledger.gaps(own).isEmpty():
            return
        rows = cut(changes(batch, stream_manifest(spark, folder)))
        if handle is not None:
            handle(batch.join(rows.select("arxiv_id"), "arxiv_id", "left_semi"), number)
        done = rows.withColumn("status", F.lit("indexed")).withColumn("batch_id", F.lit(number).cast("bigint"))
        ledger.commit(own, done, after)

    return (
        stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
