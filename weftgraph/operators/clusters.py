"""Groups of linked names, and covers of large groups by clusters of bounded size."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush, nsmallest

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.lineage import cut

#: Most edges that one task unites; about 200 bytes each.
BOUND = 500_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one task: each name with the least name of its group."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    names = list(parent)
    yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "component": pa.array([find(n) for n in names], pa.string())})


def components(edges: DataFrame, bound: int = BOUND) -> DataFrame:
    """(name, component) of every name in an edge (a, b); the component is its least name.

    At most ``bound`` different edges are united by one task. More are worked on by all:
    two steps alternate until nothing changes: every name's greater neighbours are linked to its least neighbour, then every
    name with its lesser neighbours to the least of them. Each is one aggregation and one join, and both keep the components.
    The join on a hot name is split by adaptive execution; no neighbourhood is collected.
    """

    def starred(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else pairs
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u")
        if large:
            return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        ends = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
        return ends.where("u <> v").distinct()

    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs, before = cut(pairs), None
    if pairs.count() <= bound:
        return pairs.coalesce(1).mapInArrow(_united, "name string, component string")
    while True:
        pairs = cut(starred(starred(pairs, True), False))
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("name"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("name"), F.col("v").alias("component")).distinct()
    )


def cover(pairs: list[tuple[str, str, float]], most: int) -> list[list[str]]:
    """Clusters of at most ``most`` names so that every pair is within one of them.

    A seed with the most uncovered pairs (ties: the greater name) takes its uncovered neighbours by weight, then name.
    """
    weights: dict[str, dict[str, float]] = defaultdict(dict)
    for a, b, w in pairs:
        weights[a][b] = weights[b][a] = w
    if len(weights) <= most:
        return [sorted(weights)]
    # the heap holds each name's open pairs as they once were; names come out greatest first, by their order in the alphabet
    place = {n: i for i, n in enumerate(sorted(weights, reverse=True))}
    open_pairs = {n: set(others) for n, others in weights.items()}
    heap = [(-len(others), place[n], n) for n, others in open_pairs.items()]
    heapify(heap)
    found = []
    while heap:
        size, _, seed = heappop(heap)
        if -size != len(open_pairs[seed]):  # fewer by now
            if open_pairs[seed]:
                heappush(heap, (-len(open_pairs[seed]), place[seed], seed))
            continue
        near = nsmallest(most - 1, open_pairs[seed], key=lambda n: (-weights[seed][n], n))
        cluster = [seed, *near]
        for x in cluster:
            open_pairs[x] -= set(cluster)
        if open_pairs[seed]:
            heappush(heap, (-len(open_pairs[seed]), place[seed], seed))
        found.append(sorted(cluster))
    return found


def ego_cover(weighted: DataFrame, most: int = 8, largest: int = 1_000_000) -> DataFrame:
    """(component, cluster_no, name) of a cover of the pairs (a, b, weight).

    The cover of a component is sequential, so a component is worked on by one task. Components of more than ``largest`` pairs
    are dealt by their seeds instead: each pair goes to its end with the greater degree (ties: greater name), and each end's
    pairs are cut into stars of ``most``; this needs no task that holds a component, and covers every pair too.
    """
    unordered = weighted.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "weight")
    unordered = unordered.where("a <> b").groupBy("a", "b").agg(F.max("weight").alias("weight"))
    labelled = unordered.join(components(unordered).withColumnRenamed("name", "a"), "a")
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    sized = cut(labelled.join(sizes, "component"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = cover(list(zip(group["a"], group["b"], group["weight"])), most)
        rows = [(group["component"].iat[0], i, name) for i, names in enumerate(found) for name in names]
        return pd.DataFrame(rows, columns=["component", "cluster_no", "name"])

    bounded = sized.where(F.col("n") <= largest)
    covered = bounded.select("component", "a", "b", "weight").groupBy("component").applyInPandas(
        run, "component string, cluster_no bigint, name string"
    )
    return covered.unionByName(_stars(sized.where(F.col("n") > largest), most))


def _stars(pairs: DataFrame, most: int) -> DataFrame:
    ends = pairs.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("degree"))
    a, b = (ends.withColumnsRenamed({"name": x, "degree": f"d_{x}"}) for x in ("a", "b"))
    rated = pairs.join(a, "a").join(b, "b")
    first = F.struct("d_a", "a") > F.struct("d_b", "b")
    dealt = rated.select("component", F.when(first, F.col("a")).otherwise(F.col("b")).alias("seed"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("leaf"), "weight")
    nth = F.row_number().over(Window.partitionBy("component", "seed").orderBy(F.desc("weight"), "leaf"))
    dealt = dealt.withColumn("star", F.floor((nth - 1) / (most - 1)))
    number = F.xxhash64("seed", "star")
    leaves = dealt.select("component", number.alias("cluster_no"), F.col("leaf").alias("name"))
    return leaves.unionByName(dealt.select("component", number.alias("cluster_no"), F.col("seed").alias("name")).distinct())
