"""A run over a corpus of papers: intake, cleaning, chunks, extraction, resolving, cleaning the graph, measuring, export.

Each stage stores its tables as snapshots in the run's folder, so a run that dies is taken up by the next one: papers whose
chunks were not stored stay pending, and the stages on the graph work on what is stored. After each stage the report is
published anew.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import cleaning, export, graph, intake, quality, vectors
from weftgraph.operators.chunks import TOKENS, chunks
from weftgraph.operators.decisions import DecisionProvider, EmbeddingProvider, RuleProvider
from weftgraph.operators.embedding import embedded
from weftgraph.operators.extraction import ExtractionProvider, PatternExtractor, extracted, graph_of
from weftgraph.plans import stages
from weftgraph.plans.versions import Versions
from weftgraph.sources.stores import snapshot, snapshot_or_empty
from weftgraph.streaming.intake import changes

_MANIFEST = "arxiv_id string, content_hash string, previous_hash string, status string"
_CLEANED = "arxiv_id string, text string, tokens_before bigint, tokens_after bigint, removed map<string,bigint>, flags array<string>"
_CHUNKS = "chunk_id string, arxiv_id string, ord int, tokens bigint, heading struct<heading:string,parent_headings:array<string>>, content string"
_FOUND = "chunk_id string, arxiv_id string, kind string, name string, other string, description string"
_ALIASES = "seq bigint, alias string, canonical string, verdict string, cluster_id string, reason string"
_SEEN = "name string, n_fragments int"


@dataclass
class Providers:
    """What stands in for models: extraction from chunks, vectors of names, decisions and summaries."""

    decisions: DecisionProvider = field(default_factory=RuleProvider)
    extraction: ExtractionProvider = field(default_factory=PatternExtractor)
    embedding: EmbeddingProvider | None = None


@dataclass
class Settings(stages.Settings):
    """Parameters of a run; without an embedding provider there are no candidates by vector."""

    chunk_tokens: int = TOKENS
    drop_appendix: bool = True
    neighbours: int = 10
    least_similarity: float = 0.85


class Run:
    """One corpus in a shared folder; ``run`` may be called as often as papers arrive."""

    def __init__(self, spark: SparkSession, folder: str, providers: Providers | None = None, settings: Settings | None = None) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.providers, self.settings = providers or Providers(), settings or Settings()
        self._reports = Versions(spark, f"{self.folder}/reports")
        self._report: dict = {}

    def table(self, name: str, schema: str) -> DataFrame:
        """The last stored state of a table."""
        return snapshot_or_empty(self.spark, f"{self.folder}/{name}", schema)

    def report(self) -> dict:
        """The last published report."""
        last = self._reports.latest()
        return json.loads(self._reports.read(last)) if last >= 0 else {}

    def _stage(self, name: str, **counts: int) -> None:
        self._report[name] = {"seconds": round(time.time() - self._began, 1), **counts}
        self._reports.publish(self._reports.latest() + 1, json.dumps(self._report))

    def _replaced(self, name: str, schema: str, fresh: DataFrame, papers: DataFrame) -> None:
        """Store a table with the rows of some papers in place of their older ones."""
        kept = self.table(name, schema).join(papers.select("arxiv_id"), "arxiv_id", "left_anti")
        snapshot(kept.unionByName(fresh.select(*kept.columns)), f"{self.folder}/{name}")

    def run(self, papers: DataFrame, stop_names: DataFrame | None = None) -> dict:
        """Take in papers (arxiv_id, text) that are new or changed and bring graph and exports up to date; the report.

        Papers that are known and unchanged cost a comparison of hashes. An empty table leaves the graph as it is.
        """
        self._began, self._report = time.time(), {}
        self.intake(papers)
        self.graph(stop_names)
        return self.report()

    def intake(self, papers: DataFrame) -> None:
        """Clean, cut and read the papers that are new or changed; they are indexed once all of that is stored."""
        manifest = self.table("manifest", _MANIFEST)
        todo = changes(papers, manifest)
        snapshot(todo, f"{self.folder}/pending")
        todo = self.table("pending", _MANIFEST)
        self._stage("intake", papers=todo.count())
        texts = papers.where("text IS NOT NULL").join(todo.select("arxiv_id", "content_hash"), "arxiv_id").where(F.sha2("text", 256) == F.col("content_hash"))
        fresh = cleaning.cleaned(texts.dropDuplicates(["arxiv_id"]), ["arxiv_id"], "text", self.settings.drop_appendix)
        self._replaced("cleaned", _CLEANED, fresh.drop("references"), todo)
        cleaned = self.table("cleaned", _CLEANED).join(todo.select("arxiv_id"), "arxiv_id", "left_semi")
        self._stage("clean", flagged=cleaned.where(F.size("flags") > 0).count())
        self._replaced("chunks", _CHUNKS, chunks(cleaned, "arxiv_id", "text", self.settings.chunk_tokens), todo)
        parts = self.table("chunks", _CHUNKS).join(todo.select("arxiv_id"), "arxiv_id", "left_semi")
        self._replaced("extracted", _FOUND, extracted(parts, self.providers.extraction), todo)
        indexed = todo.withColumn("status", F.lit("indexed"))
        snapshot(intake.replaced(manifest, indexed, "arxiv_id"), f"{self.folder}/manifest")
        self._stage("ingest", chunks=parts.count())

    def graph(self, stop_names: DataFrame | None = None) -> None:
        """Build, resolve and clean the graph of everything indexed, measure it and export it."""
        settings, providers = self.settings, self.providers
        found = self.table("extracted", _FOUND)
        nodes, edges = graph_of(found)
        aliases, seen = self.table("aliases", _ALIASES), self.table("seen", _SEEN)
        mentions = found.where("kind = 'entity'").select(F.trim("name").alias("name"), F.col("arxiv_id").alias("doc")).distinct()
        near = self.spark.createDataFrame([], "name string, neighbour string, sim double")
        known = self.spark.createDataFrame([], "id string, vector array<double>")
        if providers.embedding is not None:
            made = embedded(nodes.select("name", F.concat_ws(" ", "name", F.slice("fragments", 1, 3)).alias("text")), "name", "text", providers.embedding)
            snapshot(made, f"{self.folder}/vectors")
            made = self.table("vectors", "name string, vector array<double>")
            known = made.select(export.vector_id("name").alias("id"), "vector")
            ids = made.withColumnRenamed("name", "id")
            near = vectors.top_neighbours(ids, ids, settings.neighbours, settings.least_similarity).select(F.col("id").alias("name"), "neighbour", "sim")
        resolved = stages.resolve(
            nodes, edges, mentions, aliases.select("seq", "alias", "canonical", "verdict"), seen, near,
            self.table("chunks", _CHUNKS).select("chunk_id", "content"), providers.decisions, settings,
        )
        first = (aliases.agg(F.max("seq")).first()[0] or 0) + 1
        rows = resolved.alias_rows.withColumn("seq", F.monotonically_increasing_id() + first)
        snapshot(aliases.unionByName(rows.select(*aliases.columns)), f"{self.folder}/aliases")
        snapshot(resolved.seen.select("name", F.col("n_fragments").cast("int")), f"{self.folder}/seen")
        self._stage("resolve", **{k: int(v or 0) for k, v in resolved.statistics.first().asDict().items()})

        stop = self.spark.createDataFrame([], "name string") if stop_names is None else stop_names
        same = self.table("aliases", _ALIASES).where("verdict = 'same'").groupBy("alias").agg(F.max_by("canonical", "seq").alias("canonical")).where("alias <> canonical")
        concepts = export.paper_concepts(mentions.withColumnRenamed("doc", "arxiv_id"), resolved.nodes.select("name", "type"), same)
        papers = concepts.groupBy(F.col("concept").alias("name")).agg(F.collect_set("arxiv_id").alias("papers"))
        final = stages.clean_graph(resolved.nodes, resolved.edges, stop, papers, providers.decisions, settings)
        self._stage(
            "clean_graph", nodes=final.nodes.count(), edges=final.edges.count(), stopped=final.stopped.count(), low_evidence=final.low_evidence.count()
        )
        gate = quality.type_gate(final.nodes).first()
        several = graph.flagged_hubs(final.hubs).count()
        self._stage("quality", open_nodes=gate["open_nodes"], passed=bool(gate["passed"]), hubs_flagged=several)
        renamed = final.renamed.select(F.col("name").alias("alias"), F.col("renamed").alias("canonical"))
        led = export.paper_concepts(mentions.withColumnRenamed("doc", "arxiv_id"), final.nodes.select("name", "type"), same.unionByName(renamed.join(same, "alias", "left_anti")))
        tables = export.sinks(final.nodes, final.edges, self.table("chunks", _CHUNKS), led, known)
        tables["review_merges"] = (export.review_sheet(resolved.merges, "correct? (y/n)"), "csv")
        export.write_all(self.spark, f"{self.folder}/export", tables)
        self._stage("export", tables=len(tables))
