"""Filling containers of fixed capacity with items of varying size.

Only the number of items of each size matters for a packing, and there are at most as many sizes as the capacity, so the
packing is planned on this histogram: at most ``capacity`` rows reach the driver however many items there are. The plan
first fixes, by the reduction of Martello and Toth, small sets of items that dominate every other way to fill a container,
then gives the rest to the fullest containers they fit in, greatest items first. Equal containers are one entry of the plan
with a count. Items then take the plan's places by their rank among the items of their size, in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftgraph.llm.tokens import VOCABULARY, with_token_counts
from weftgraph.plans.lineage import cut

#: Parts into which the items of one size are dealt before they are ranked; a size may hold most of the items.
SALTS = 64


@dataclass
class Filling:
    """``count`` containers with the same contents: size -> items of that size in each."""

    count: int
    contents: dict[int, int]


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[Filling], dict[int, int]]:
    """Fillings that some best packing contains, and the counts of the sizes that are left.

    For the greatest size s that is left, with what is left besides it:
    - nothing fits besides s: s alone dominates;
    - a size fills the container exactly, or at most one more item fits: s with the greatest size that fits dominates;
    - at most two more items fit, and the greatest size that fits is no less than the best pair: s with it dominates.
    A set is fixed as often as its items last; the conditions stay true while they do.
    """
    left = {s: n for s, n in counts.items() if n > 0 and s > 0}
    fixed: list[Filling] = []
    sizes = sorted(left)

    def take(*items: int) -> None:
        contents: dict[int, int] = {}
        for s in items:
            contents[s] = contents.get(s, 0) + 1
        times = min(left[s] // n for s, n in contents.items())
        fixed.append(Filling(times, contents))
        for s, n in contents.items():
            left[s] -= times * n
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def smallest(besides: int, n: int) -> list[int]:
        found: list[int] = []
        for s in sizes:
            found += [s] * min(n - len(found), left[s] - (s == besides))
            if len(found) == n:
                break
        return found

    def greatest(room: int, besides: int) -> int | None:
        i = bisect_left(sizes, room + 1) - 1
        while i >= 0 and left[sizes[i]] - (sizes[i] == besides) < 1:
            i -= 1
        return sizes[i] if i >= 0 else None

    at = len(sizes) - 1
    while sizes and at >= 0:
        at = min(at, len(sizes) - 1)
        s = sizes[at]
        room = capacity - s
        other = greatest(room, s)
        if other is None:
            take(s)
            continue
        low = smallest(s, 3)
        if other == room or len(low) < 2 or low[0] + low[1] > room:
            take(s, other)
            continue
        if len(low) < 3 or sum(low) > room:
            pair = 0
            for a in sizes[: bisect_left(sizes, room + 1)]:
                if left[a] - (a == s) < 1:
                    continue
                b = greatest(room - a, s)
                if b is not None and (a != b or left[a] - (a == s) >= 2):
                    pair = max(pair, a + b)
            if other >= pair:
                take(s, other)
                continue
        at -= 1
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best fit, greatest sizes first, equal containers at once."""
    open_by_room: dict[int, list[Filling]] = {}
    rooms: list[int] = []
    done: list[Filling] = []

    def put(room: int, filling: Filling) -> None:
        if not filling.count:
            return
        if room == 0:
            done.append(filling)
            return
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append(filling)

    for size in sorted((s for s, n in counts.items() if n > 0 and s > 0), reverse=True):
        n = counts[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                filling = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(i)
            else:
                room, filling = capacity, Filling(-(-n // (capacity // size)), {})
            each = room // size
            full = min(filling.count, n // each)
            rest = n - full * each if full < filling.count else 0
            put(room - each * size, Filling(full, filling.contents | {size: each}))
            n -= full * each
            if rest:
                put(room - rest * size, Filling(1, filling.contents | {size: rest}))
                n -= rest
            put(room, Filling(filling.count - full - (rest > 0), filling.contents))
    return done + [f for fillings in open_by_room.values() for f in fillings]


def plan(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Fillings that hold every item of the histogram exactly once; sizes must be from 1 to the capacity."""
    fixed, left = reduced(counts, capacity)
    return [f for f in fixed + best_fit(left, capacity) if f.count]


def _places(fillings: list[Filling]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By size: the first ranks of its runs of places, each run's first container and its items per container."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for f in fillings:
        for size, each in f.contents.items():
            runs.setdefault(size, []).append((used.get(size, 0), first, each))
            used[size] = used.get(size, 0) + f.count * each
        first += f.count
    return {s: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for s, r in runs.items()}


def sized_pieces(df: DataFrame, key: str, text: str, capacity: int, vocabulary: str) -> DataFrame:
    """(key, piece_no, n_tokens): one row for each item, or for each full container and the rest of an item beyond capacity."""
    sizes = with_token_counts(df.where(F.col(key).isNotNull()), [key], text, vocabulary)
    last = F.greatest(F.ceil(F.col("n_tokens") / capacity) - 1, F.lit(0))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    return sizes.select(key, "n_tokens", numbers.alias("piece_no")).select(
        key, F.col("piece_no").cast("int").alias("piece_no"), F.least(F.col("n_tokens") - F.col("piece_no") * capacity, F.lit(capacity)).alias("n_tokens")
    )


def packed(
    df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 4096, vocabulary: str = VOCABULARY
) -> DataFrame:
    """(key, piece_no, n_tokens, container): every item in one container, or in several if it is greater than a container.

    An item beyond the capacity is cut into full containers and a rest that shares one; no other item is cut. Tokens of all
    items in a container add up to the capacity at most. Empty and null texts have no tokens and go to container 0. Rows
    with a null key are left out, since nothing could be told to be in a container; repeated keys are items of their own.
    An empty table gives no rows. Other columns are ignored.
    """
    pieces = cut(sized_pieces(df, key, text, capacity, vocabulary))
    histogram = pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()  # at most `capacity` rows
    places = _places(plan({r["n_tokens"]: r["count"] for r in histogram}, capacity))
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64(key, "piece_no"), F.lit(SALTS)))
    within = Window.partitionBy("n_tokens", "salt").orderBy(key, "piece_no")
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("n_tokens", "salt").count().select(
        "n_tokens", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    ranked = (
        dealt.withColumn("nth", F.row_number().over(within) - 1)
        .join(offsets, ["n_tokens", "salt"])
        .select(key, "piece_no", "n_tokens", (F.col("nth") + F.col("offset")).alias("rank"))
    )
    schema = T.StructType([*[pieces.schema[c] for c in (key, "piece_no", "n_tokens")], T.StructField("container", T.LongType())])
    arrow = to_arrow_schema(schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(i).to_numpy() for i in (2, 3))
            container = np.zeros(len(size), dtype=np.int64)
            order = np.argsort(size, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else []:
                if size[rows[0]]:
                    start, first, each = places[int(size[rows[0]])]
                    run = np.searchsorted(start, rank[rows], side="right") - 1
                    container[rows] = first[run] + (rank[rows] - start[run]) // each[run]
            columns = [*batch.columns[:3], pa.array(container)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return ranked.mapInArrow(place, schema)
