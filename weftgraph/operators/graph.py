"""Cleaning the graph: generic names, loops, names of one paper, long descriptions, weak evidence, hubs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.functions.names import norm_key

#: Fixed value: labels that papers use for their own parts.
PAPER_LOCAL = (
    r"(?i)^(model|mixture|setting|variant|config(uration)?|system|method|baseline|dataset|split|run|group|case|condition|arm)"
    r"\s+([a-z]|\d{1,2}|[ivx]{1,4})$"
)


def degrees(edges: DataFrame, name: str = "name") -> DataFrame:
    """(name, degree): edges at each end of (src, dst); a loop counts twice."""
    return edges.select(F.explode(F.array("src", "dst")).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("degree"))


def without_stopped(nodes: DataFrame, stop: DataFrame) -> DataFrame:
    """Nodes whose key is none of the stop names' (name)."""
    keys = stop.select(norm_key(F.col("name")).alias("stop_key")).distinct()
    return nodes.withColumn("stop_key", norm_key(F.col("name"))).join(keys, "stop_key", "left_anti").drop("stop_key")


def stopped(nodes: DataFrame, stop: DataFrame) -> DataFrame:
    """(name, degree) of the nodes that the stop names remove."""
    keys = stop.select(norm_key(F.col("name")).alias("stop_key")).distinct()
    return nodes.withColumn("stop_key", norm_key(F.col("name"))).join(keys, "stop_key", "left_semi").select("name", "degree")


def without_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends are nodes."""
    names = nodes.select("name")
    return edges.join(names.withColumnRenamed("name", "src"), "src", "left_semi").join(
        names.withColumnRenamed("name", "dst"), "dst", "left_semi"
    )


def self_loops(edges: DataFrame) -> DataFrame:
    """(name): nodes that have an edge to themselves."""
    return edges.where("src = dst").select(F.col("src").alias("name")).distinct()


def without_loops(edges: DataFrame) -> DataFrame:
    """Edges between different nodes."""
    return edges.where("src <> dst")


def paper_local_names(nodes: DataFrame) -> DataFrame:
    """(name, renamed) of names such as "Model A" that one paper only uses, if the new name with its id is free.

    ``nodes`` has (name, papers): the different papers of a node.
    """
    local = nodes.where(F.col("name").rlike(PAPER_LOCAL) & (F.size(F.array_distinct("papers")) == 1))
    named = local.select("name", F.concat("name", F.lit(" ("), F.try_element_at("papers", F.lit(1)), F.lit(")")).alias("renamed"))
    return named.join(nodes.select(F.col("name").alias("renamed")), "renamed", "left_anti").select("name", "renamed")


def condensed(nodes: DataFrame, provider, least: int = 8) -> DataFrame:
    """(name, fragments, summary) of nodes with at least so many fragments; ``fragments`` is their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            summaries = [provider.summarise(n, list(f)) for n, f in zip(batch["name"], batch["fragments"])]
            yield pd.DataFrame({"name": batch["name"], "fragments": [len(f) for f in batch["fragments"]], "summary": summaries})

    todo = nodes.where(F.size("fragments") >= least).select("name", "fragments")
    return todo.mapInPandas(run, "name string, fragments bigint, summary string")


def low_evidence(nodes: DataFrame) -> DataFrame:
    """(name) of nodes with at most one different chunk and no edge; nodes has (name, source_ids, degree)."""
    return nodes.where((F.size(F.array_distinct("source_ids")) <= 1) & (F.coalesce("degree", F.lit(0)) == 0)).select("name")


def hubs(nodes: DataFrame, most: int = 50) -> DataFrame:
    """The nodes of greatest degree; ties by name."""
    return nodes.orderBy(F.desc("degree"), "name").limit(most)


def hub_evidence(top: DataFrame, edges: DataFrame, seed: int = 0, incident: int = 200, most: int = 12, length: int = 500) -> DataFrame:
    """(name, fragments): for each hub some of its own and its edges' description fragments, in an order by hash.

    ``incident`` and ``most`` are what a reviewer is shown; the first edges by neighbour are taken.
    """
    own = top.select("name", F.explode("fragments").alias("text"))
    ends = edges.select(F.col("src").alias("name"), F.col("dst").alias("other"), "description").unionByName(
        edges.select(F.col("dst").alias("name"), F.col("src").alias("other"), "description")
    )
    near = ends.join(top.select("name"), "name", "left_semi")
    nth = F.row_number().over(Window.partitionBy("name").orderBy("other"))
    around = near.withColumn("nth", nth).where(F.col("nth") <= incident).select("name", F.explode(F.split("description", "<SEP>")).alias("text"))
    pool = own.unionByName(around).where(F.trim("text") != "")
    mixed = F.row_number().over(Window.partitionBy("name").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "name", "text")), "text"))
    shown = pool.withColumn("place", mixed).where(F.col("place") <= most)
    return shown.groupBy("name").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", F.substring("text", 1, length).alias("t")))), lambda x: x["t"]).alias("fragments")
    )


def hub_verdicts(shown: DataFrame, provider) -> DataFrame:
    """(name, verdict, senses, reason): what a provider says of each hub's fragments."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [provider.review(n, list(f)) for n, f in zip(batch["name"], batch["fragments"])]
            yield pd.DataFrame({"name": batch["name"], **{k: [a[k] for a in answers] for k in ("verdict", "senses", "reason")}})

    return shown.mapInPandas(run, "name string, verdict string, senses array<string>, reason string")


def flagged_hubs(verdicts: DataFrame) -> DataFrame:
    """(name) of the hubs whose fragments were found to be of several concepts."""
    return verdicts.where("verdict = 'several'").select("name")
