"""The most similar vectors of every vector, by an inverted multi-index.

Unit vectors are cut into two halves, and each half is quantised by its own centroids, so a cell of the index is a pair of
centroids. For a query the pairs are traversed with a heap by the sum of the two distances by which the query's halves lie
on their own centroid's side of the border to the other centroid; that sum bounds from below how far vectors of the cell
are. The traversal ends where it exceeds a limit: the greatest squared distance asked for, which loses nothing, or less,
calibrated on the sample's own pairs for a wanted recall. Entries of the cells are reranked by exact cosines, in blocks of
which each vector's best are kept at once. Pairs found from either side count for both.

Vectors travel once to each first-half list that one of their cells is in. Lists are split by entries, so that no task holds
more than a bounded number, and by queries, as a list in the middle of all vectors is near to most of them; queries stream
past the entries. Vectors with many identical copies take part once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.lineage import cut

#: Vectors the centroids are fitted on, about, chosen by the hashes of their ids (twice as many at most); rounds of the fit.
SAMPLE, ROUNDS = 20_000, 10

#: Vectors for each cell, on average, that the number of centroids aims at, and the most centroids of a half.
FILL, MOST = 32, 1024

#: Entries of a list that one task holds, and queries that stream past them in one task, as expected from the sample.
LIST, QUERIES = 20_000, 20_000

#: Share of the pairs asked for that the traversal's limit is calibrated to reach, and the share of the greatest squared
#: distance that the limit has at least, for samples with few pairs.
RECALL, SPREAD = 0.9995, 0.02

#: Queries and entries that are multiplied at once, pairs that are held before each query's best are kept, and vectors with
#: their cells that one task is dealt, on average.
BLOCK, HELD, DEALT = (1024, 4096), 2_000_000, 20_000

#: Identical vectors from which only one of them is searched.
COPIES = 64


def valid(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that have ``dim`` numbers, not all of them zero, and these vectors at length 1."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten() if len(at) else pa.array([], pa.float32())
    rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    norms = np.linalg.norm(rows, axis=1)
    good = np.isfinite(norms) & (norms > 0)
    return at[good], (rows[good] / norms[good][:, None]).astype(np.float32)


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids**2).sum(axis=1) - 2 * rows @ centroids.T


def fit(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` centroids of the rows; fewer if there are fewer different rows."""
    rows = np.unique(rows, axis=0)
    k = min(k, len(rows))
    centroids = rows[np.random.default_rng(0).choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(rows, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=k)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids).astype(np.float32)
    return centroids


class MultiIndex:
    """Centroids of both halves, and the distances between them."""

    def __init__(self, sample: np.ndarray, k: int) -> None:
        self.middle = sample.shape[1] // 2
        self.centroids = [fit(sample[:, : self.middle], k), fit(sample[:, self.middle :], k)]
        self.apart = [
            np.sqrt(np.maximum(_distances(c, c) + (c**2).sum(axis=1)[:, None], 1e-12)) for c in self.centroids
        ]

    def borders(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half each row's centroid, and its squared distances from the borders to all centroids."""
        result = []
        for half, centroids, apart in zip((rows[:, : self.middle], rows[:, self.middle :]), self.centroids, self.apart):
            distances = _distances(half, centroids)
            own = distances.argmin(axis=1)
            beyond = distances - distances[np.arange(len(rows)), own][:, None]
            result.append((own, (beyond / (2 * apart[own])) ** 2))
        return result


def traverse(first: np.ndarray, second: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Pairs of places in two lists by the sum of their values, as far as the sum is within the limit."""
    a, b = np.flatnonzero(first <= limit), np.flatnonzero(second <= limit)
    a, b = a[np.argsort(first[a], kind="stable")].tolist(), b[np.argsort(second[b], kind="stable")].tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap, found = [(x[0] + y[0], 0, 0)], []
    while heap:
        total, i, j = heappop(heap)
        if total > limit:
            break
        found.append((a[i], b[j]))
        if j + 1 < len(b):
            heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return found


def calibrated(index: MultiIndex, sample: np.ndarray, borders, least: float, recall: float) -> float:
    """The limit within which ``recall`` of the sample's pairs with a cosine of ``least`` lie, seen from the better side."""
    greatest = 2 * (1 - least)
    if recall >= 1:
        return greatest
    (own1, near1), (own2, near2) = borders
    needs = []
    for low in range(0, len(sample), BLOCK[0]):
        q, e = np.nonzero(sample[low : low + BLOCK[0]] @ sample.T >= least)
        q += low
        once = q < e
        q, e = q[once], e[once]
        there = near1[q, own1[e]] + near2[q, own2[e]]
        needs.append(np.minimum(there, near1[e, own1[q]] + near2[e, own2[q]]))
    need = np.concatenate(needs)
    reached = float(np.quantile(need, recall)) if len(need) else 0.0
    return min(greatest, max(SPREAD * greatest, reached))


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


_ROUTED = "list int, part int, entry boolean, asks boolean, id bigint, cells binary, vector binary"
_PAIRS = "a bigint, b bigint, cosine double"


def cells_by_list(own: tuple[int, int], first: np.ndarray, second: np.ndarray, limit: float) -> dict[int, list[int]]:
    """By first half the second halves of the cells to look into; the own cell comes first."""
    found: dict[int, list[int]] = {own[0]: [own[1]]}
    for c1, c2 in traverse(first, second, limit):
        into = found.setdefault(c1, [])
        if (c1, c2) != own:
            into.append(c2)
    return found


def _routes(dim: int, index: MultiIndex, splits: dict[int, tuple[int, int]], limit: float):
    """Each vector to all lists that hold one of its cells, with the second halves of these cells; home cell first.

    A list's parts are numbered by entries and then queries: an entry is in all query parts of its own entry part, a query in
    its own query part of all entry parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for low in range(0, big.num_rows, 4096):
                batch = big.slice(low, 4096)
                at, rows = valid(batch.column(1), dim)
                if not len(at):
                    continue
                ids = batch.column(0).take(pa.array(at)).to_numpy()
                (own1, near1), (own2, near2) = index.borders(rows)
                lists, parts, entry, asks, owner, cells = [], [], [], [], [], []
                for i in range(len(at)):
                    home = int(own1[i])
                    for c1, c2s in cells_by_list((home, int(own2[i])), near1[i], near2[i], limit).items():
                        by_entry, by_query = splits.get(c1, (1, 1))
                        e, q = int(ids[i]) % by_entry, (int(ids[i]) // by_entry) % by_query
                        codes = np.array(c2s, dtype=np.uint16).tobytes()
                        asked = {x * by_query + q for x in range(by_entry)}
                        held = {e * by_query + x for x in range(by_query)} if c1 == home else set()
                        for part in sorted(asked | held):
                            lists.append(c1)
                            parts.append(part)
                            entry.append(part in held)
                            asks.append(part in asked)
                            owner.append(i)
                            cells.append(codes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lists, pa.int32()),
                        pa.array(parts, pa.int32()),
                        pa.array(entry, pa.bool_()),
                        pa.array(asks, pa.bool_()),
                        pa.array(ids[owner]),
                        pa.array(cells, pa.binary()),
                        _binary(rows[owner]),
                    ],
                    names=["list", "part", "entry", "asks", "id", "cells", "vector"],
                )

    return run


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32).reshape(-1, dim)


def _rerank(dim: int, k: int, least: float):
    """Pairs of each list: its entries, which come first, against the vectors that look into their cells."""

    def best(q: np.ndarray, e: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, ...]:
        """The k best entries of each vector; entries are numbered by their ids, so ties go to the smaller id."""
        order = np.lexsort((e, -cosine, q))
        q, e, cosine = q[order], e[order], cosine[order]
        head = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
        on = rank < k
        return q[on], e[on], cosine[on]

    def block(q: np.ndarray, e: np.ndarray, ids, rows, entries) -> tuple[np.ndarray, ...]:
        """Pairs of some vectors and some entries with a cosine of ``least``; of dense blocks only each vector's best."""
        entry_ids, _, entry_rows, by_id, _ = entries
        near = rows[q] @ entry_rows[e].T >= least - 1e-5
        near &= ids[q][:, None] != entry_ids[e]
        if np.count_nonzero(near) > 4 * k * len(q):
            exact = np.round(rows[q].astype(np.float64) @ entry_rows[e].astype(np.float64).T, 7)
            exact[~near | (exact < least)] = -2
            # a whole number for each place: the cosine, and of equal ones the smaller id
            places = np.rint(exact * 1e7).astype(np.int64) * len(by_id) - by_id[e]
            kept = np.argpartition(-places, min(k, len(e) - 1), axis=1)[:, :k]
            x = np.repeat(np.arange(len(q)), kept.shape[1])
            y = kept.ravel()
            cosine = exact[x, y]
        else:
            x, y = np.nonzero(near)
            cosine = np.round(np.einsum("ij,ij->i", rows[q[x]].astype(np.float64), entry_rows[e[y]].astype(np.float64)), 7)
        on = cosine >= least
        return q[x[on]], by_id[e[y[on]]], cosine[on]

    def within(entries, ids, cells, rows) -> pa.RecordBatch | None:
        """The k best entries of each vector, among those of its cells; pairs with the lesser id first."""
        looked = np.concatenate([np.frombuffer(c, dtype=np.uint16) for c in cells])
        who = np.repeat(np.arange(len(ids)), [len(c) // 2 for c in cells])
        order = np.argsort(looked, kind="stable")
        looked, who = looked[order], who[order]
        starts = np.flatnonzero(np.diff(looked, prepend=-1))
        found, size = [], 0
        for s, t in zip(starts, np.append(starts[1:], len(looked))):
            low, high = np.searchsorted(entries[1], [looked[s], looked[s] + 1])
            for a in range(s, t, BLOCK[0]):
                for b in range(low, high, BLOCK[1]):
                    found.append(block(who[a : min(t, a + BLOCK[0])], np.arange(b, min(high, b + BLOCK[1])), ids, rows, entries))
                    size += len(found[-1][0])
                    if size > HELD:
                        found = [best(*(np.concatenate([f[i] for f in found]) for i in range(3)))]
                        size = len(found[0][0]) // 2
        if not found:
            return None
        q, e, cosine = best(*(np.concatenate([f[i] for f in found]) for i in range(3)))
        if not len(q):
            return None
        a, b = ids[q], entries[4][e]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (np.minimum(a, b), np.maximum(a, b), cosine)], names=["a", "b", "cosine"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, entries, asked = None, [], None, []
        waiting = 0

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal asked, entries, waiting
            if held and entries is None:
                ids, cells, rows = (np.concatenate([h[i] for h in held]) for i in range(3))
                order = np.lexsort((ids, cells))
                ranked = np.argsort(ids[order], kind="stable")
                by_id = np.empty(len(ids), np.int64)
                by_id[ranked] = np.arange(len(ids))
                # by cell; the number of each by its id, and the ids in that order
                entries = ids[order], cells[order], rows[order], by_id, ids[order][ranked]
            if waiting and entries:
                result = within(
                    entries, np.concatenate([x[0] for x in asked]), [c for x in asked for c in x[1]], np.concatenate([x[2] for x in asked])
                )
                if result:
                    yield result
            asked, waiting = [], 0

        for batch in batches:
            lists, parts, entry, asks, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            heads = np.flatnonzero((np.diff(lists, prepend=-1) != 0) | (np.diff(parts, prepend=-1) != 0))
            heads = np.unique(np.append(heads, 0))
            for low, high in zip(heads, np.append(heads[1:], batch.num_rows)):
                if now != (lists[low], parts[low]):
                    yield from answers()
                    now, held, entries = (lists[low], parts[low]), [], None
                part = batch.slice(low, high - low)
                cells, rows = part.column(5).to_pylist(), _vectors(part.column(6), dim)
                mine, own = entry[low:high].astype(bool), asks[low:high].astype(bool)
                if mine.any():
                    home = np.array([int.from_bytes(c[:2], "little") for c, m in zip(cells, mine) if m], dtype=np.int64)
                    held.append((ids[low:high][mine], home, rows[mine]))
                asked.append((ids[low:high][own], [c for c, o in zip(cells, own) if o], rows[own]))
                waiting += int(own.sum())
                if waiting >= 20_000 and not mine[-1]:
                    yield from answers()
        yield from answers()

    return run


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "vectors", k: int = 10, least: float = 0.85, recall: float = RECALL
) -> DataFrame:
    """(key, neighbour, cosine, rank): for each vector its k most similar others with a cosine of at least ``least``.

    Ties go to the smaller key; cosines count to seven decimals. The result is approximate: a pair can be missed if neither
    vector's traversal reaches the other's cell. ``recall`` is the share of pairs that the traversal is calibrated to reach; with
    1 it is exact. Null, all-zero, too short and not finite vectors, and null keys, are
    left out; the length is that of the longest. Keys must be unique integers. Identical vectors are neighbours with cosine
    1, however many there are. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v")).where("id IS NOT NULL")
    dim, n = rows.agg(F.max(F.size("v")), F.count("v")).head()
    schema = f"{key} bigint, neighbour bigint, cosine double, rank int"
    if not n or (dim or 0) < 2:
        return spark.createDataFrame([], schema)
    share = F.lit(int(min(1.0, SAMPLE / n) * (1 << 30)))
    picked = rows.where((F.size("v") == dim) & (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)).limit(2 * SAMPLE).toArrow()
    sample = valid(picked.column(1).combine_chunks(), dim)[1]
    if not len(sample):
        return spark.createDataFrame([], schema)
    index = MultiIndex(sample, int(min(MOST, max(4, 2 ** round(np.log2(max(n / FILL, 1)) / 2)))))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = valid(batch.column(1), dim)
            lists = _distances(found[:, : index.middle], index.centroids[0]).argmin(axis=1) if len(at) else []
            ids, same = (batch.column(i).take(pa.array(at)) for i in (0, 2))
            yield pa.RecordBatch.from_arrays([ids, same, pa.array(lists, pa.int32())], names=["id", "same", "list"])

    coded = cut(rows.withColumn("same", F.xxhash64("v")).mapInArrow(codes, "id bigint, same bigint, list int"))
    many = coded.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where(F.col("n") > max(COPIES, k + 1))
    many = cut(many)
    copied = not many.isEmpty()
    searched, firsts = coded, None
    if copied:
        copies = coded.join(many.select("same", "first"), "same").select("id", "first")
        place = F.row_number().over(Window.partitionBy("first").orderBy("id"))
        firsts = cut(copies.withColumn("place", place).where(F.col("place") <= k + 1).select("first", "id"))
        dropped = copies.where("id <> first").select("id")
        searched, rows = coded.join(dropped, "id", "left_anti"), rows.join(dropped, "id", "left_anti")
    counts = searched.groupBy("list").count().collect()  # as many rows as centroids
    (own1, near1), (own2, near2) = borders = index.borders(sample)
    limit = calibrated(index, sample, borders, least, recall)
    near = Counter(c for i in range(len(sample)) for c in cells_by_list((own1[i], own2[i]), near1[i], near2[i], limit))
    splits = {
        r["list"]: (-(-r["count"] // LIST), max(1, round(near[r["list"]] * n / len(sample) / QUERIES))) for r in counts
    }
    routed = rows.mapInArrow(_routes(dim, index, splits, limit), _ROUTED)
    dealt = sum(near.values()) * n / len(sample) + n  # as expected from the sample; a list's parts are bounded by LIST and QUERIES
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-int(dealt) // DEALT))
    routed = routed.repartition(parts, "list", "part").sortWithinPartitions("list", "part", F.desc("entry"))
    pairs = routed.mapInArrow(_rerank(dim, k, least), _PAIRS).groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    ends = F.array(
        F.struct(F.col("a").alias("id"), F.col("b").alias("neighbour")), F.struct(F.col("b").alias("id"), F.col("a").alias("neighbour"))
    )
    links = pairs.select(F.inline(ends), "cosine")
    if copied:
        spread_out = links.join(firsts.select(F.col("first").alias("neighbour"), F.col("id").alias("copy")), "neighbour", "left")
        links = spread_out.select("id", F.coalesce("copy", "neighbour").alias("neighbour"), "cosine")
        links = links.unionByName(
            copies.join(firsts.withColumnRenamed("id", "neighbour"), "first")
            .where("id <> neighbour")
            .select("id", "neighbour", F.lit(1.0).alias("cosine"))
        )
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour"))
    best = links.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("id").alias(key), "neighbour", "cosine", "rank")
