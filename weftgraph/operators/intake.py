"""Which papers a run must touch, and the records it writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.strings import filled
from weftgraph.operators.incremental import Ledger, islands


def _plain(column: str) -> Column:
    return F.lower(filled(column))


def latest_scan(scan: DataFrame) -> DataFrame:
    """Per paper the hash of its latest look that has one: arxiv_id, content_hash (trimmed, lower case)."""
    return (
        scan.select("arxiv_id", _plain("content_hash").alias("content_hash"), "scanned_at")
        .where(F.col("arxiv_id").isNotNull() & F.col("content_hash").isNotNull())
        .groupBy("arxiv_id")
        .agg(F.max(F.struct("scanned_at", "content_hash")).alias("last"))
        .select("arxiv_id", F.col("last.content_hash").alias("content_hash"))
    )


def latest_state(manifest: DataFrame) -> DataFrame:
    """Per paper the hash and status of its latest manifest row by recorded_at (ties: loaded_at, then run_no)."""
    return (
        manifest.where(F.col("arxiv_id").isNotNull())
        .groupBy("arxiv_id")
        .agg(
            F.max(
                F.struct(
                    "recorded_at",
                    "loaded_at",
                    "run_no",
                    _plain("content_hash").alias("content_hash"),
                    _plain("status").alias("status"),
                )
            ).alias("last")
        )
        .select("arxiv_id", F.col("last.content_hash").alias("known_hash"), F.col("last.status").alias("status"))
    )


def pending(scan: DataFrame, manifest: DataFrame, ledger: Ledger, process=lambda papers: papers.select("arxiv_id")) -> int | None:
    """Process the papers of the scan that are new, changed or not finished, each once; the number of the committed run.

    Each paper's present hash is registered with the ledger and has a sequence number. Before the first run, the numbers of
    papers whose latest manifest row is ``indexed`` with that hash are committed as processed. The run then subtracts the
    processed intervals from the numbers of the scan and hands the papers in the gaps (arxiv_id, content_hash, seq) to
    ``process``; what that returns is committed with the intervals. None where nothing is pending.

    Case and outer blanks of hash and status don't matter. Papers without an id or without any hash are no papers of the
    scan; a null hash or status in the manifest never counts as finished. Ties in scanned_at: the greater hash. Repeated
    rows change nothing; an empty scan leaves nothing to do, an empty manifest all papers. Other columns are ignored.
    """
    papers = ledger.register(latest_scan(scan), "arxiv_id", "content_hash")
    if not ledger.runs():
        done = (F.col("content_hash") == F.col("known_hash")) & (F.col("status") == "indexed")
        finished = papers.join(latest_state(manifest), "arxiv_id").where(done)
        ledger.commit(islands(finished), papers.sparkSession.createDataFrame([], "arxiv_id string"), -1)
    return ledger.run(papers, process)


def content_hash(text: Column) -> Column:
    """sha-256 of a text."""
    return F.sha2(text, 256)


def intake(papers: DataFrame, manifest: DataFrame, metadata: DataFrame) -> DataFrame:
    """Manifest records of papers (arxiv_id, content_hash) that are new, changed or not finished.

    A paper without a row in the manifest is new, any other is changed. Metadata overwrites what was known, with nulls too;
    columns that intake doesn't set keep the known values.
    """
    known = manifest.withColumnsRenamed({"content_hash": "known_hash", "status": "known_status"}).drop(
        "previous_hash", "title", "authors", "submitted", "categories"
    )
    joined = papers.join(known.withColumn("known", F.lit(True)), "arxiv_id", "left").join(metadata, "arxiv_id", "left")
    same = F.coalesce((F.col("known_hash") == F.col("content_hash")) & (F.col("known_status") == "indexed"), F.lit(False))
    changed = joined.where(~same).withColumn("previous_hash", F.col("known_hash"))
    return changed.withColumn("status", F.when(F.col("known").isNull(), "new").otherwise("changed")).drop("known_hash", "known_status", "known")


def replaced(documents: DataFrame, fresh: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with those of ``fresh`` in place of older ones with the same key."""
    return documents.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def with_status(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """The manifest with status indexed or failed for papers (arxiv_id, doc_status) of a run; others keep theirs."""
    joined = manifest.join(processed.select("arxiv_id", "doc_status"), "arxiv_id", "left")
    done = F.when(F.lower("doc_status").endswith("processed"), "indexed").otherwise("failed")
    return joined.withColumn("status", F.when(F.col("doc_status").isNull(), F.col("status")).otherwise(done)).drop("doc_status")


def in_corpus(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """References (with arxiv_id) and whether the paper they name is in the manifest."""
    known = manifest.select("arxiv_id").where("arxiv_id IS NOT NULL").distinct().withColumn("in_corpus", F.lit(True))
    return entries.join(known, "arxiv_id", "left").withColumn("in_corpus", F.coalesce("in_corpus", F.lit(False)))
