"""One group identifier for all records that pairwise matches link directly or indirectly.

Union-find runs inside each partition of the edges and keeps only a spanning forest of stars. Forests are merged level by
level: each level maps every vertex to its least neighbour, which removes most vertices, and runs union-find again inside
the partitions of what is left, until the forest fits into one bounded task. The levels' maps are then walked back.
Vertices are ordered by a hash of their name, so a level shrinks chains as well as stars. Edges are never collected by
vertex: a vertex that a third of all edges share leaves at most one edge per partition and vertex.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.strings import filled
from weftgraph.plans.lineage import cut

#: Most forest edges of one task, which holds about 200 bytes an edge. Small, so that levels are usual rather than an exception.
BOUND = 50_000


def roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least vertex of the component of each of ``n`` vertices, by hooking greater roots to lesser ones."""
    parent = np.arange(n)
    while True:
        a, b = parent[u], parent[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_edges = low != high
        if not open_edges.any():
            return parent
        u, v, low, high = u[open_edges], v[open_edges], low[open_edges], high[open_edges]
        np.minimum.at(parent, high, low)
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped


def _forest(u: pa.Array, v: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Stars (child, root) of the components of the edges; the root is the least vertex."""
    names = pc.unique(pa.concat_arrays([u, v]))
    names = names.take(pc.array_sort_indices(names))
    a, b = (pc.index_in(x, names).to_numpy() for x in (u, v))
    root = roots(a, b, len(names))
    child = np.flatnonzero(root != np.arange(len(names)))
    return names.take(pa.array(child)), names.take(pa.array(root[child]))


def _spanning(bound: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The forest of a partition; where it grows beyond the bound, it is given out and a new one begun."""
        kept: list[tuple[pa.Array, pa.Array]] = []
        size = 0

        def shrink():
            nonlocal kept, size
            u, v = (pa.concat_arrays([x[i] for x in kept]).cast(pa.string()) for i in (0, 1))
            kept = [_forest(u, v)]
            size = len(kept[0][0])

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(list(kept[0]), names=["u", "v"])

        for batch in batches:
            kept.append((batch.column(0), batch.column(1)))
            size += batch.num_rows
            if size >= bound:
                shrink()
                if size > bound // 2:
                    yield given()
                    kept, size = [], 0
        if kept:
            shrink()
            yield given()

    return run


def linked(edges: DataFrame, a: str, b: str, bound: int = BOUND) -> DataFrame:
    """(name, group_name) for every name in a group of at least two; group_name is the group's least name by code point.

    Names are trimmed of white space. Edges with a null or empty name or from a name to itself link nothing; repeated edges
    and both directions change nothing; further columns are ignored. No edges give no rows. ``bound`` limits the edges of
    one task, whatever the number of edges; more edges mean more levels.
    """

    def ranked(name: Column) -> Column:
        return F.concat(F.lpad(F.hex(F.xxhash64(name)), 16, "0"), name)

    def spanned(df: DataFrame, limit: int = bound) -> DataFrame:
        return df.select("u", "v").mapInArrow(_spanning(limit), "u string, v string")

    named = edges.select(filled(a).alias("u"), filled(b).alias("v")).where("u <> v")
    forest = cut(spanned(named.select(ranked(F.col("u")).alias("u"), ranked(F.col("v")).alias("v"))))
    size, maps = forest.count(), []
    while size > bound:
        parts = max(2, -(-size // bound))
        least = cut(forest.groupBy("u").agg(F.min("v").alias("to")))
        maps.append(least)
        moved = forest.join(least, "u").select("v", F.col("to").alias("a"))
        moved = moved.join(least.select(F.col("u").alias("v"), F.col("to").alias("b")), "v", "left")
        moved = moved.select(F.col("a").alias("u"), F.coalesce("b", "v").alias("v")).where("u <> v").distinct()
        forest = cut(spanned(moved.repartition(parts, F.greatest("u", "v"))))
        size = forest.count()
    # one partition may have given out several forests too
    last = spanned(forest.coalesce(1), 2 * bound)
    labels = cut(last.select("u", F.col("v").alias("root")))
    for least in reversed(maps):
        below = least.join(labels.select(F.col("u").alias("to"), "root"), "to", "left")
        below = below.select("u", F.coalesce("root", "to").alias("root"))
        labels = below.unionByName(labels.join(below.select("u"), "u", "left_anti"))
    bare = F.substring("vertex", 17, 1 << 30)
    members = labels.select(F.col("u").alias("vertex"), "root").unionByName(
        labels.select(F.col("root").alias("vertex"), "root").distinct()
    )
    members = members.select(bare.alias("name"), "root")
    least_names = members.groupBy("root").agg(F.min("name").alias("group_name"))
    return members.join(least_names, "root").select("name", "group_name")
