"""Merging names in the graph: code merges, applying a mapping to nodes and edges, the merge log and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.names import norm_key


def code_merges(nodes: DataFrame) -> DataFrame:
    """(name, canonical, key, type) of names that share key and type with others; nodes has (name, type, papers, degree).

    The canonical name is that of most papers, then degree, least length and greatest spelling. One aggregation finds it and
    one join gives it to the members, so a group of any size is never collected.
    """
    keyed = nodes.select("name", "type", "papers", "degree", norm_key(F.col("name")).alias("key"))
    order = F.struct("papers", "degree", (-F.char_length("name")).alias("short"), "name")
    groups = keyed.groupBy("key", "type").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = groups.select(F.col("key").alias("k"), F.col("type").alias("t"), "best")
    joined = keyed.join(groups, (F.col("key") == F.col("k")) & F.col("type").eqNullSafe(F.col("t")))
    return joined.select("name", F.col("best.name").alias("canonical"), "key", "type")


def merged_nodes(nodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Nodes after merging: (name, type, fragments, source_ids, papers) with the members' lists joined, the canonical first.

    ``mapping`` is (name, canonical); names without a row stay. The type is the canonical name's.
    """
    moved = nodes.join(mapping.select("name", "canonical"), "name", "left").withColumn("to", F.coalesce("canonical", "name"))
    part = F.struct((F.col("name") != F.col("to")).alias("other"), "name", "type", "fragments", "source_ids")
    grouped = moved.groupBy("to").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.max("papers").alias("papers"))
    return grouped.select(
        F.col("to").alias("name"),
        F.try_element_at("parts", F.lit(1))["type"].alias("type"),
        F.flatten(F.transform("parts", lambda p: p["fragments"])).alias("fragments"),
        F.flatten(F.transform("parts", lambda p: p["source_ids"])).alias("source_ids"),
        "papers",
    )


def merged_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Undirected edges (src, dst, weight, description) between merged names: weights summed, loops dropped.

    Different descriptions are joined in order; edges are grouped by both ends, so a hub's edges are spread over tasks.
    """
    names = mapping.select("name", "canonical")
    for end in ("src", "dst"):
        renamed = names.withColumnsRenamed({"name": end, "canonical": f"{end}_to"})
        edges = edges.join(renamed, end, "left").withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
    ordered = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight", "description")
    return ordered.where("src <> dst").groupBy("src", "dst").agg(
        F.sum("weight").alias("weight"), F.array_join(F.sort_array(F.collect_set("description")), "<SEP>").alias("description")
    )


def merge_log(mapping: DataFrame, nodes: DataFrame, method: str) -> DataFrame:
    """(canonical, aliases, method, types): one row per merge; mapping has (name, canonical)."""
    types = nodes.select("name", "type")
    rows = mapping.select("name", "canonical").join(types, "name")
    return rows.groupBy("canonical").agg(
        F.sort_array(F.collect_set(F.when(F.col("name") != F.col("canonical"), F.col("name")))).alias("aliases"),
        F.lit(method).alias("method"),
        F.sort_array(F.collect_set("type")).alias("types"),
    )


def resolve_statistics(nodes_before: DataFrame, nodes_after: DataFrame, pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """One row of counts: entities before and after, candidate pairs, clusters, second looks, groups, related, unsure."""
    one = lambda df, *aggs: df.agg(*aggs)
    return (
        one(nodes_before, F.count(F.lit(1)).alias("entities_before"))
        .crossJoin(one(nodes_after, F.count(F.lit(1)).alias("entities_after")))
        .crossJoin(one(pairs, F.count(F.lit(1)).alias("candidate_pairs")))
        .crossJoin(
            one(
                answers,
                F.count(F.lit(1)).alias("clusters"),
                F.coalesce(F.sum(F.size("members")), F.lit(0)).alias("names_in_clusters"),
                F.count_if("second_look").alias("second_looks"),
                F.coalesce(F.sum(F.size("same")), F.lit(0)).alias("same_groups"),
                F.coalesce(F.sum(F.size("related")), F.lit(0)).alias("related"),
                F.coalesce(F.sum(F.size("different")), F.lit(0)).alias("different_pairs"),
                F.coalesce(F.sum(F.size("unsure")), F.lit(0)).alias("unsure_final"),
                F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_groups"),
            )
        )
    )  # joins of single rows
