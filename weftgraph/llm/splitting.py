"""Splitting items that are too long at natural boundaries, with overlap.

The cuts of an item are a path in a successor table: every boundary leads to the farthest boundary that a piece beginning
there, overlap included, may end at. Squaring the table doubles the number of cuts that are known, so all cuts of a batch
of items are found in a logarithmic number of array operations, however many pieces the longest item has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Kinds of boundaries, the stronger the greater.
ANYWHERE, WORD, SENTENCE, LINE, PARAGRAPH = range(5)

_BLANK = np.array([i for i in range(0x3001) if chr(i).isspace()], dtype=np.uint32)
_END = np.array([ord(c) for c in ".!?…。！？"], dtype=np.uint32)
_CLOSING = np.array([ord(c) for c in "\"')]}»”’"], dtype=np.uint32)

#: Characters that are worked on at once; a longer item is a batch of its own.
CHUNK = 2_000_000


def boundaries(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions where pieces may begin or end, and their kinds.

    A boundary follows a run of blanks. Every item's start and end are boundaries; stretches of more than ``step``
    characters without one get boundaries of the weakest kind.
    """
    blank = np.isin(chars, _BLANK)
    after = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1 if len(chars) else np.zeros(0, np.int64)
    before = np.flatnonzero(~blank[:-1] & blank[1:]) + 1 if len(chars) else np.zeros(0, np.int64)
    begin = before[np.searchsorted(before, after, side="right") - 1] if len(before) else np.zeros(len(after), np.int64)
    begin = np.where(begin < after, begin, 0)
    newlines = np.concatenate([[0], np.cumsum(chars == 10)])
    breaks = newlines[after] - newlines[begin]
    last = np.maximum(begin - 1, 0)
    last = np.where(np.isin(chars[last], _CLOSING) & (last > 0), last - 1, last)
    kind = np.where(np.isin(chars[last], _END), SENTENCE, WORD)
    kind = np.where(breaks == 1, LINE, np.where(breaks > 1, PARAGRAPH, kind))
    place = np.concatenate([after, starts, ends])
    kind = np.concatenate([kind, np.full(len(starts) + len(ends), PARAGRAPH)])
    place, first = np.unique(place[np.argsort(-kind, kind="stable")], return_index=True)
    kind = kind[np.argsort(-kind, kind="stable")][first]
    gaps = np.diff(place)
    wide = np.flatnonzero(gaps > step)
    if len(wide):
        more = (gaps[wide] - 1) // step
        which = np.repeat(wide, more)
        nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        place = np.concatenate([place, place[which] + nth * step])
        kind = np.concatenate([kind, np.full(len(which), ANYWHERE)])
        order = np.argsort(place, kind="stable")
        place, kind = place[order], kind[order]
    return place, kind


def successors(place: np.ndarray, kind: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """For each boundary the index of the one its piece ends at; ends of items lead to themselves.

    That is the item's end if it is in reach, else the farthest paragraph, line or sentence end that fills at least half of
    the room, in this order, else the farthest word end, else the farthest boundary of all.
    """
    item = np.searchsorted(starts, place, side="right") - 1
    first = place == starts[item]
    room = np.where(first, limit, limit - overlap)
    reach = np.minimum(place + room, ends[item])
    result = np.searchsorted(place, reach, side="right") - 1
    undecided = reach < ends[item]
    for least, share in ((PARAGRAPH, 2), (LINE, 2), (SENTENCE, 2), (WORD, 4)):
        strong = np.flatnonzero(kind >= least)
        if not len(strong):
            continue
        at = strong[np.maximum(np.searchsorted(place[strong], reach, side="right") - 1, 0)]
        good = undecided & (place[at] <= reach) & (place[at] >= place + np.maximum(room // share, 1))
        result = np.where(good, at, result)
        undecided &= ~good
    return np.where(place == ends[item], np.arange(len(place)), result)


def cuts(chars: np.ndarray, lengths: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all cuts of the items whose characters follow each other in ``chars``, and the item of each.

    A separator character must stand behind each item. An item's cuts begin with its start and end with its end.
    """
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = starts + lengths
    place, kind = boundaries(chars, starts, ends, max(1, (limit - overlap) // 8))
    jump = successors(place, kind, starts, ends, limit, overlap)
    known = np.zeros(len(place), dtype=bool)
    known[np.searchsorted(place, starts)] = True
    while True:
        found = np.flatnonzero(known)
        known[jump[found]] = True
        squared = jump[jump]
        if (squared == jump).all():
            break
        jump = squared
    place = place[known]
    return place, np.searchsorted(starts, place, side="right") - 1


def pieces(texts: list[str], limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Item, number, start and end of every piece of the non-empty texts."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    chars = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    place, item = cuts(chars, lengths, limit, overlap)
    inner = np.flatnonzero(item[:-1] == item[1:])
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    item_of, begin, end = item[inner], place[inner] - starts[item[inner]], place[inner + 1] - starts[item[inner]]
    head = np.flatnonzero(np.diff(item_of, prepend=-1))
    number = np.arange(len(item_of)) - np.repeat(head, np.diff(np.append(head, len(item_of))))
    return item_of, number, np.where(number > 0, begin - overlap, begin), end


def split_oversized(items: DataFrame, keys: list[str], text: str, limit: int = 1500, overlap: int = 150) -> DataFrame:
    """(keys, piece_no, piece_start, piece_end, piece) for every item; lengths and positions are in code points.

    Pieces are at most ``limit`` long. Each but the first begins ``overlap`` before the end of the one before, and without
    these repeats the pieces of an item join to its text. Items that fit are one piece. Cuts prefer paragraphs, then lines,
    sentences and words; a word is cut only where nothing else is in reach.

    Null and empty texts give no pieces. Null keys are kept like others, repeated rows give repeated pieces, an empty table
    no rows. Columns other than keys and text are left out, so their names can't clash; keys must not be called like the
    piece columns. Texts of any length are cut as a whole.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")
    rows = items.select(*keys, F.col(text).alias("__text"))
    size = F.char_length("__text")
    fitting = rows.where((size > 0) & (size <= limit)).select(
        *keys, F.lit(0).alias("piece_no"), F.lit(0).alias("piece_start"), size.cast("int").alias("piece_end"), F.col("__text").alias("piece")
    )
    schema = T.StructType([*[rows.schema[k] for k in keys], *[fitting.schema[c] for c in ("piece_no", "piece_start", "piece_end", "piece")]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
            edges = [0, *np.flatnonzero(np.diff(sizes // CHUNK, prepend=0)).tolist(), len(column)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                texts = column.slice(low, high - low).to_pylist()
                item, number, begin, end = pieces(texts, limit, overlap)
                parts = [texts[i][a:b] for i, a, b in zip(item.tolist(), begin.tolist(), end.tolist())]
                rows = batch.slice(low, high - low).take(pa.array(item))
                values = [pa.array(number), pa.array(begin), pa.array(end), pa.array(parts, pa.string())]
                columns = [*rows.columns[:-1], *values]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return fitting.unionByName(rows.where(size > limit).mapInArrow(run, schema))
