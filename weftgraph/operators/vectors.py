"""Exact nearest neighbours: by blocks of a stated query set against all vectors, or of all vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries of one pass over the vectors; more queries are more passes.
BLOCK = 50_000


def top_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 10, least: float = -1.0, key: str = "id", vector: str = "vector", block: int = BLOCK
) -> DataFrame:
    """(id, neighbour, sim, rank): exact cosines of each query's k most similar other vectors, to four decimals.

    Queries are taken in blocks of bounded size; each block is sent to all tasks, which keep k candidates per query and
    partition, so vectors are never shuffled and no pairs are written out. Ties go to the smaller id. Null, all-zero and
    odd-length vectors are left out; no queries give no rows.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[key].dataType.simpleString()
    schema = f"id {id_type}, neighbour {id_type}, sim double"
    rows = vectors.select(key, F.col(vector).cast("array<double>").alias("v")).where(F.col(key).isNotNull() & F.col("v").isNotNull())
    asked = queries.select(key, F.col(vector).cast("array<double>").alias("v")).where(F.col(key).isNotNull() & F.col("v").isNotNull())
    parts, now = [], []

    def unit(values: list[list[float]]) -> np.ndarray:
        m = np.array(values, dtype=np.float64)
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    def good(v: list[float], dim: int) -> bool:
        return len(v) == dim and None not in v and any(v)

    def flush() -> None:
        dim = len(now[0][1])
        ids, matrix = [i for i, _ in now], unit([v for _, v in now])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = [[] for _ in ids]
            for batch in batches:
                found = [(i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if good(v, dim)]
                for low in range(0, len(found), 2048):
                    part = found[low : low + 2048]
                    names = [i for i, _ in part]
                    sims = np.round(matrix @ unit([v for _, v in part]).T, 4)
                    floor = np.array([b[-1][0] if len(b) >= k else -9.0 for b in best])
                    for q, j in zip(*np.nonzero((sims >= floor[:, None]) & (sims >= least))):
                        if names[j] != ids[q]:
                            best[q].append((float(sims[q, j]), names[j]))
                    for q in range(len(best)):
                        if len(best[q]) > k:
                            best[q] = sorted(best[q], key=lambda x: (-x[0], x[1]))[:k]
            out = [(ids[q], n, s) for q, b in enumerate(best) for s, n in b]
            yield pa.RecordBatch.from_pydict({"id": [o[0] for o in out], "neighbour": [o[1] for o in out], "sim": [o[2] for o in out]})

        parts.append(rows.mapInArrow(run, schema))

    for row in asked.toLocalIterator():
        if not row[1] or None in row[1] or not any(row[1]) or (now and len(row[1]) != len(now[0][1])):
            continue
        now.append((row[0], row[1]))
        if len(now) == block:
            flush()
            now = []
    if now:
        flush()
    union = spark.createDataFrame([], schema)
    for part in parts:
        union = union.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "neighbour"))
    return union.withColumn("rank", rank).where(F.col("rank") <= k)


#: Vectors of a group at most, and at least where there are more cores than groups; vectors of the sample, and its stretches.
GROUP, SMALL, SAMPLE, STRETCHES = 200_000, 2048, 16_384, 64

#: Rows and columns that are multiplied at once, and pairs that are held before each vector's best are kept.
TILE, HELD = (512, 1024), 250_000

#: What rounding two cosines to four decimals, and computing them with 32 bits, can add to their difference.
ROUNDED = 1.2e-4

#: In the place of a half, vectors that come as a whole group.
WHOLE = 2


def _numbers(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that have ``dim`` finite numbers, not all of them zero, and these vectors."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(at)).flatten()
    rows = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # null numbers are NaN
    good = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
    return at[good], rows[good]


def _units(rows: np.ndarray) -> np.ndarray:
    wide = rows.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _flat(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of a column of bytes, one after another."""
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, kind)
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, kind, (ends[-1] - ends[0]) // np.dtype(kind).itemsize, int(ends[0]))


def _over(block: np.ndarray, least: float) -> np.ndarray:
    """Places in a flat block whose length eight divides where it is not less than ``least``."""
    mask = block >= np.float32(least)
    words = np.flatnonzero(mask.view(np.uint64))
    which, bits = np.nonzero(mask.reshape(-1, 8)[words])
    return words[which] * 8 + bits


def _ranks(sorted_keys: np.ndarray) -> np.ndarray:
    """The place of each key among equal ones."""
    heads = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    return np.arange(len(sorted_keys)) - np.repeat(heads, np.diff(np.append(heads, len(sorted_keys))))


class _Side:
    """Some vectors with the best neighbours found so far; below its floor nothing can be among a vector's best."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, floors: np.ndarray, k: int) -> None:
        self.ids, self.rows, self.floors, self.k = ids, rows, floors.astype(np.float32), k
        self.norms = np.concatenate([np.linalg.norm(rows[low : low + 4096].astype(np.float64), axis=1) for low in range(0, len(rows), 4096)])
        self.names, self.sims = np.full((len(ids), k), -1, np.int64), np.full((len(ids), k), -9.0)
        self.held, self.size = [], 0

    def units(self, low: int, high: int) -> np.ndarray:
        return (self.rows[low:high] / self.norms[low:high, None]).astype(np.float32)

    def take(self, q: np.ndarray, other: _Side, e: np.ndarray, cosine: np.ndarray) -> None:
        """Pairs of own places and the other's, of which those that can be among the best are computed exactly and held."""
        order = np.lexsort((-cosine, q))
        q, e, cosine = q[order], e[order], cosine[order]
        ranks = _ranks(q)
        last = np.full(len(self.ids), -9.0, np.float32)
        last[q[ranks == self.k - 1]] = cosine[ranks == self.k - 1] - np.float32(ROUNDED)
        on = cosine >= np.maximum(last, self.floors)[q]
        q, e = q[on], e[on]
        sims = np.empty(len(q))
        for low in range(0, len(q), 50_000):
            a, b = q[low : low + 50_000], e[low : low + 50_000]
            dots = np.einsum("ij,ij->i", self.rows[a].astype(np.float64), other.rows[b].astype(np.float64))
            sims[low : low + 50_000] = np.round(dots / self.norms[a] / other.norms[b], 4)
        self.held.append((q, other.ids[e], sims))
        self.size += len(q)
        if self.size > HELD:
            self.settle()

    def settle(self) -> None:
        """Keep of what is held the k best of each vector; ties go to the smaller id."""
        if not self.size:
            return
        q, names, sims = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        self.held, self.size = [], 0
        asked = np.unique(q)
        q = np.concatenate([q, np.repeat(asked, self.k)])
        names = np.concatenate([names, self.names[asked].ravel()])
        sims = np.concatenate([sims, self.sims[asked].ravel()])
        order = np.lexsort((names, -sims, q))
        q, names, sims = q[order], names[order], sims[order]
        ranks = _ranks(q)
        on = ranks < self.k
        self.names[q[on], ranks[on]], self.sims[q[on], ranks[on]] = names[on], sims[on]
        self.floors[asked] = np.maximum(self.floors[asked], self.sims[asked, -1] - ROUNDED / 2)

    def lists(self) -> Iterator[pa.RecordBatch]:
        self.settle()
        for low in range(0, len(self.ids), 4096):
            part = slice(low, low + 4096)
            lists = [pa.array([r.tobytes() for r in x]) for x in (self.names[part], np.rint(self.sims[part] * 1e4).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[part]), *lists], names=["id", "names", "sims"])


def _meet(rows: _Side, columns: _Side, buffer: np.ndarray, start: int = 0) -> None:
    """Each pair of the two sides, or each different pair of one side, offered to both of its vectors; columns from ``start`` on."""
    one = rows is columns
    for top in range(0, len(rows.ids), TILE[0]):
        a = rows.units(top, top + TILE[0])
        held, size = [], 0

        def flush() -> None:
            r, c, s = (np.concatenate([h[i] for h in held]) for i in range(3))
            if one:
                r, c, s = np.concatenate([r, c]), np.concatenate([c, r]), np.concatenate([s, s])
            near = s >= rows.floors[r]
            rows.take(r[near], columns, c[near], s[near])
            if not one:
                near = s >= columns.floors[c]
                columns.take(c[near], rows, r[near], s[near])

        for left in range(top if one else start, len(columns.ids), TILE[1]):
            b = columns.units(left, left + TILE[1])
            n = len(a) * len(b)
            block = buffer[: n + -n % 8]
            block[n:] = -9
            np.matmul(a, b.T, out=block[:n].reshape(len(a), len(b)))
            floors = rows.floors[top : top + TILE[0]], columns.floors[left : left + TILE[1]]
            over = _over(block, min(f.min() for f in floors))
            for low in range(0, len(over), HELD):
                at = over[low : low + HELD]
                at = at[at < n]
                r, c, s = at // len(b), at % len(b), block[at]
                on = (s >= floors[0][r]) | (s >= floors[1][c])
                r, c, s = r[on] + top, c[on] + left, s[on]
                if one:
                    r, c, s = r[r < c], c[r < c], s[r < c]
                held.append((r, c, s))
                size += len(r)
                if size > HELD:
                    flush()
                    held, size = [], 0
        if size:
            flush()


def all_neighbours(vectors: DataFrame, k: int = 10, key: str = "id", vector: str = "vector") -> DataFrame:
    """(id, neighbour, sim, rank): exact cosines of every vector's k most similar others, to four decimals.

    All pairs are computed, each once: vectors are dealt to groups by their ids' hashes, and a task holds one group, which meets
    itself and half of the other groups, streamed past it. Of two groups that face each other, as there are if groups are even in
    number, each task takes one half of the same group. Both vectors of a pair may keep it. Cosines of 32
    bits tell what can't be among the best, the rest is computed with 64. A vector's floor, from which a neighbour must be, starts
    as what it has among a bounded sample and rises with what is found. Time grows with the square of the vectors, memory of a
    task doesn't grow. Ties go to the smaller id. Ids must be unique integers. Null, all-zero and not finite vectors, null ids,
    and lengths other than the longest are left out.
    """
    spark = vectors.sparkSession
    wide = "double" in vectors.schema[vector].dataType.simpleString()
    kind = np.float64 if wide else np.float32
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast(f"array<{'double' if wide else 'float'}>").alias("v"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    dim, n = rows.agg(F.max(F.size("v")), F.count("v")).head()
    if not n or not dim:
        return spark.createDataFrame([], "id bigint, neighbour bigint, sim double, rank int")
    share = F.lit(int(min(1.0, SAMPLE / n) * (1 << 30)))
    picked = rows.where((F.size("v") == dim) & (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) < share)).select("v").limit(2 * SAMPLE).toArrow()
    sample = _units(_numbers(picked.column(0).combine_chunks(), dim)[1]) if picked.num_rows else np.empty((0, dim), np.float32)
    stretch = max(1, len(sample) // STRETCHES)
    sample = sample[: len(sample) // stretch * stretch]
    groups = max(1, -(-n // GROUP), min(spark.sparkContext.defaultParallelism, n // SMALL))
    facing = groups // 2 if groups % 2 == 0 else groups

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for low in range(0, big.num_rows, 1024):
                batch = big.slice(low, 1024)
                at, found = _numbers(batch.column(1), dim)
                floors = np.full(len(at), -9.0, np.float32)
                if len(sample) > k * stretch and len(at):
                    # a vector may be in the sample itself, so that one more of the stretches' greatest cosines is needed
                    greatest = (_units(found) @ sample.T).reshape(len(at), -1, stretch).max(axis=2)
                    floors = -np.partition(-greatest, k, axis=1)[:, k] - np.float32(ROUNDED)
                found = np.ascontiguousarray(found, kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(floors), pa.array([r.tobytes() for r in found], pa.binary())], names=["id", "floor", "v"]
                )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, second = None, [], 0
        buffer = np.empty(TILE[0] * TILE[1] + 8, np.float32)

        def arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
            ids, floors, away, half = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            return [ids, floors, away, half, np.array(_flat(batch.column(2), kind)).reshape(-1, dim)]

        def held() -> None:
            nonlocal own, parts, second
            ids, floors, _, half, rows = (np.concatenate([p[i] for p in parts]) for i in range(5))
            own, parts, second = _Side(ids, rows, floors, k), [], int(np.searchsorted(half, 1))
            _meet(own, own, buffer)

        for now in map(arrays, batches):
            first = int(np.searchsorted(now[2] > 0, True))
            if first:
                parts.append([x[:first] for x in now])
            if first < len(now[2]) and own is None and parts:
                held()
            for faces in (False, True):
                ids, floors, away, half, rows = (x[first:][(now[2][first:] == facing) == faces] for x in now)
                if own is None or not len(ids):
                    continue
                other = _Side(ids, rows, floors, k)
                # tasks of the upper groups get the whole group that faces theirs, for the second half of their own
                _meet(other, own, buffer, second if half[0] == WHOLE else 0)
                yield from other.lists()
        if own is None and parts:
            held()
        if own is not None:
            yield from own.lists()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each vector's lists, which follow one another."""

        def best(ids: np.ndarray, names: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
            ids, names, sims = np.repeat(ids, k), names.ravel(), sims.ravel()
            there = sims >= -10_000
            ids, names, sims = ids[there], names[there], sims[there]
            order = np.lexsort((names, -sims, ids))
            ids, names, sims = ids[order], names[order], sims[order]
            ranks = _ranks(np.unique(ids, return_inverse=True)[1])
            on = ranks < k
            return pa.RecordBatch.from_arrays(
                [pa.array(x[on]) for x in (ids, names, sims / 1e4, (ranks + 1).astype(np.int32))], names=["id", "neighbour", "sim", "rank"]
            )

        rest = np.empty(0, np.int64), np.empty((0, k), np.int64), np.empty((0, k), np.int32)
        for batch in batches:
            now = (
                batch.column(0).to_numpy(),
                _flat(batch.column(1), np.int64).reshape(-1, k),
                _flat(batch.column(2), np.int32).reshape(-1, k),
            )
            now = tuple(np.concatenate([r, x]) for r, x in zip(rest, now))
            whole = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if whole:
                yield best(*(x[:whole] for x in now))
            rest = tuple(x[whole:] for x in now)
        if len(rest[0]):
            yield best(*rest)

    hashed, away = F.xxhash64("id"), F.col("away")
    dealt = rows.mapInArrow(packed, "id bigint, floor float, v binary").withColumns({"group": F.pmod(hashed, F.lit(groups)), "half": F.pmod(F.shiftright(hashed, 32), F.lit(2))})
    dealt = dealt.withColumn("away", F.explode(F.sequence(F.lit(0), F.lit(groups // 2)))).withColumn("task", F.pmod(F.col("group") - away, F.lit(groups)))
    upper = (away == facing) & (F.col("task") >= facing)
    dealt = dealt.where((away != facing) | upper | (F.col("half") == 0)).withColumn("half", F.when(upper, WHOLE).otherwise(F.col("half")))
    dealt = dealt.select("id", "floor", "v", away.cast("int").alias("away"), F.col("half").cast("int").alias("half"), F.col("task").cast("int").alias("task"))
    # the own group, zero groups away, comes first; vectors with like floors meet at once
    order = F.col("away") > 0, F.when(F.col("away") == 0, F.col("half")), F.col("floor")
    lists = dealt.repartitionById(groups, F.col("task")).sortWithinPartitions(*order).select("id", "floor", "v", "away", "half")
    lists = lists.mapInArrow(met, "id bigint, names binary, sims binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lists.repartition(parts, "id").sortWithinPartitions("id").mapInArrow(merged, "id bigint, neighbour bigint, sim double, rank int")
