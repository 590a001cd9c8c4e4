"""The stages of a run: resolving names, cleaning the graph, measuring. Each takes and gives DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.operators import aliases, candidates, clusters, decisions, graph, merging, quality
from weftgraph.plans.lineage import cut


@dataclass
class Settings:
    """Parameters of resolution and graph cleanup."""

    strong: float = 0.90
    cluster_size: int = 8
    first_look: tuple[int, int] = (600, 2)
    second_look: tuple[int, int] = (4000, 5)
    hubs: int = 50
    condense_from: int = 8
    seed: int = 0


@dataclass
class Resolution:
    """What resolution gives: the merged graph, what was decided, and what the next run needs."""

    nodes: DataFrame
    edges: DataFrame
    pairs: DataFrame
    answers: DataFrame
    merges: DataFrame
    alias_rows: DataFrame
    seen: DataFrame
    statistics: DataFrame


def _with_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.drop("degree").join(graph.degrees(edges), "name", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))


def _mapped(nodes: DataFrame, edges: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    moved = cut(merging.merged_edges(edges.select("src", "dst", "weight", "description"), mapping))
    return cut(_with_degree(merging.merged_nodes(nodes, mapping), moved)), moved


def focus(nodes: DataFrame, seen: DataFrame) -> DataFrame:
    """Nodes with ``focus``: whether their number of fragments isn't what the last run (name, n_fragments) saw."""
    known = seen.select("name", F.col("n_fragments").cast("bigint").alias("n"))
    joined = nodes.join(known, "name", "left")
    return joined.withColumn("focus", ~F.size("fragments").cast("bigint").eqNullSafe(F.col("n"))).drop("n")


def resolve(
    nodes: DataFrame,
    edges: DataFrame,
    extracted: DataFrame,
    alias_rows: DataFrame,
    seen: DataFrame,
    neighbours: DataFrame,
    chunks: DataFrame,
    provider: decisions.DecisionProvider,
    settings: Settings = Settings(),
) -> Resolution:
    """Merge names for the same concept.

    Known aliases are replayed, candidates come from keys, neighbours (name, neighbour, sim) and acronyms and touch a name in
    focus, names of equal key and type are merged, a provider decides on clusters of the other candidates, and its groups
    are merged. Of the names of one key that code merges leave, all pairs are candidates, so neither a merged name nor a
    decided pair cuts off the others. ``nodes``: name, type, fragments, source_ids, files; ``edges``: src, dst, weight, description;
    ``extracted``: name, doc; ``alias_rows``: seq, alias, canonical, verdict.
    """
    before = cut(nodes)
    canonical = cut(aliases.canonical_of(alias_rows))
    papers = candidates.paper_counts(before, extracted, canonical)
    current = before.join(papers, "name").select("name", "type", "fragments", "source_ids", "papers")
    names = current.select("name")
    led = aliases.resolved(canonical.where("alias <> canonical"), names)
    known = led.where("name <> final").join(names.withColumnRenamed("name", "final"), "final", "left_semi")
    replayed = cut(known.select("name", F.col("final").alias("canonical")))
    current, edges = _mapped(current, edges, replayed)

    focused = cut(focus(current, seen).withColumn("description", F.array_join("fragments", " ")))
    alive = neighbours.join(names, "name", "left_semi")
    by_key = cut(merging.code_merges(current))
    left = current.select("name").join(by_key.where("name <> canonical"), "name", "left_anti")
    stars, survivors = candidates.key_pairs(focused, every=False), candidates.key_pairs(focused, left=left)
    pairs = candidates.candidates(
        {
            "key": stars.unionByName(survivors),
            "vector": candidates.accepted_neighbours(alive.join(focused.where("focus").select("name"), "name", "left_semi"), focused, settings.strong),
            "acronym": candidates.acronym_pairs(focused),
            "acronym-def": candidates.defined_acronyms(focused),
        },
        aliases.decided_pairs(alias_rows),
    )
    pairs = cut(pairs)
    current, edges = _mapped(current, edges, by_key)
    left = current.select("name")
    open_pairs = pairs.join(left.withColumnRenamed("name", "a"), "a", "left_semi").join(left.withColumnRenamed("name", "b"), "b", "left_semi")
    weighted = open_pairs.select("a", "b", F.coalesce("sim", F.lit(1.0)).alias("weight"))
    covered = clusters.ego_cover(weighted, settings.cluster_size)
    covered = cut(covered.select(F.concat_ws("-", F.lit("c"), F.md5("component"), "cluster_no").alias("cluster_id"), "name"))

    members = current.join(covered.select("name").distinct(), "name", "left_semi")
    looks = []
    for length, examples in (settings.first_look, settings.second_look):
        shown = decisions.evidence(members, chunks, examples)
        looks.append(decisions.payloads(covered, members, shown, length))
    answers = cut(decisions.decide(*looks, provider))
    decided = cut(decisions.same_groups(answers, current).select("name", "canonical"))
    logs = [
        merging.merge_log(mapping, before.select("name", "type"), method)
        for mapping, method in ((replayed.unionByName(replayed.select(F.col("canonical").alias("name"), "canonical").distinct()), "alias"), (by_key, "code"), (decided, "llm"))
    ]
    current, edges = _mapped(current, edges, decided)
    edges = edges.unionByName(decisions.related_edges(answers, edges, current), allowMissingColumns=True)
    rows = decisions.alias_rows(answers)
    for mapping, method in ((by_key, "code"), (decided, "llm")):
        merged = mapping.where("name <> canonical").select(
            F.col("name").alias("alias"), "canonical", F.lit("same").alias("verdict"), F.lit(method).alias("cluster_id"), F.lit("").alias("reason")
        )
        rows = rows.unionByName(merged)
    merges = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return Resolution(
        nodes=current,
        edges=edges,
        pairs=pairs,
        answers=answers,
        merges=merges,
        alias_rows=rows,
        seen=current.select("name", F.size("fragments").alias("n_fragments")),
        statistics=merging.resolve_statistics(before, current, pairs, answers),
    )


@dataclass
class CleanGraph:
    """The graph after cleanup, and what cleanup found."""

    nodes: DataFrame
    edges: DataFrame
    stopped: DataFrame
    loops: DataFrame
    renamed: DataFrame
    condensed: DataFrame
    low_evidence: DataFrame
    hubs: DataFrame


def clean_graph(nodes: DataFrame, edges: DataFrame, stop: DataFrame, papers: DataFrame, provider, settings: Settings = Settings()) -> CleanGraph:
    """Remove generic names and loops, rename labels of one paper, condense long descriptions, review hubs.

    ``papers`` has (name, papers): the different papers of each node.
    """
    gone = cut(graph.stopped(nodes, stop))
    kept = cut(graph.without_stopped(nodes, stop))
    loops = graph.self_loops(edges)
    linked = graph.without_loops(graph.without_nodes(edges, kept))
    renamed = cut(graph.paper_local_names(kept.select("name").join(papers, "name")))
    mapping = renamed.select("name", F.col("renamed").alias("canonical"))
    named = kept.join(mapping, "name", "left").withColumn("name", F.coalesce("canonical", "name")).drop("canonical")
    linked = cut(merging.merged_edges(linked.select("src", "dst", "weight", "description"), mapping))
    summaries = cut(graph.condensed(named, provider, settings.condense_from))
    short = named.join(summaries.select("name", "summary"), "name", "left")
    short = short.withColumn("fragments", F.when(F.col("summary").isNull(), F.col("fragments")).otherwise(F.array("summary"))).drop("summary")
    final = cut(_with_degree(short, linked))
    shown = graph.hub_evidence(graph.hubs(final, settings.hubs), linked, settings.seed)
    return CleanGraph(final, linked, gone, loops, renamed, summaries.select("name", "fragments"), graph.low_evidence(final), graph.hub_verdicts(shown, provider))


def measure(nodes: DataFrame, calls: DataFrame, cache: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
    """Tables of a batch's measurements: types, gate, gleaning, calls by kind, parameters."""
    return {
        "types": quality.type_distribution(nodes),
        "gate": quality.type_gate(nodes),
        "gleaning": quality.gleaning_effect(quality.extraction_rows(cache)),
        "calls": quality.calls_by_kind(calls),
        "parameters": quality.batch_parameters(counts),
    }
