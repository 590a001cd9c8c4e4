"""Which corpus documents reproduce held-out test items, wholly or in part.

The corpus is indexed once. The index is distributed by document: each segment holds, for some thousand documents, the
positions of every word, so a word that is in a third of all documents has a bounded list in each segment, and lists are
intersected where they are stored. Items are looked up in blocks of a bounded number of words, each block in one pass over
the index, not over the texts.

Within a segment the lists of two successive item words are intersected at an offset of one. A case has a known least
number of such pairs, so of an item's pairs in order of their counts the commonest ones, half that number, need not be
looked up at first. Documents that share enough of the rarest pairs are looked up with all pairs, whose offsets must agree
in one passage or two. What is left is aligned word by word; the words between equal ones are read from the index too, by
turning the segment's lists back into the order of its words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftgraph.llm.alignment import REACH, drift, folded, reproduced
from weftgraph.plans.lineage import shared_folder, stored

#: Words of test items that are looked up in one pass over the index.
BLOCK = 400_000

#: Words from which a segment of the index is closed; a longer document is a segment of its own.
SEGMENT = 500_000

#: Share of the words of passages that must match; the others are changed words.
DENSE = 0.84

#: Share of the words of passages that must stand in runs of two or more equal words; with each third word misspelt it is 2/3.
EXACT = 0.6

#: Pairs of documents and items, and places of pairs of words, that are counted at once.
CELLS = 4_000_000


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in order, and how often each is there."""
    ordered = np.sort(numbers)
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[heads], np.diff(np.append(heads, len(ordered)))


def _two_greatest(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The sum of the two greatest values of each of ``n`` owners."""
    total = np.zeros(n, np.int64)
    order = np.lexsort((-value, owner))
    owner, value = owner[order], value[order]
    head = np.flatnonzero(np.diff(owner, prepend=-1))
    total[owner[head]] = value[head]
    second = head[head + 1 < len(owner)] + 1
    second = second[owner[second] == owner[second - 1]]
    total[owner[second]] += value[second]
    return total


def _repeated(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers first, first + 1, ... of each stretch of ``count`` numbers, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


class Segment:
    """Some documents and the positions of all their words. Documents are set apart by one empty position."""

    def __init__(self, lengths: np.ndarray, terms: list[str], counts: np.ndarray, places: np.ndarray) -> None:
        self.starts = np.append(0, np.cumsum(lengths + 1))
        self.terms, self.counts, self.places = terms, counts, places

    @classmethod
    def of(cls, texts: list[str]) -> Segment:
        """The segment of folded texts."""
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        lengths = pc.list_value_length(parts).to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        at = np.arange(len(codes)) + np.repeat(np.arange(len(texts)), lengths)
        terms = coded.dictionary.to_pylist()
        return cls(lengths, terms, np.bincount(codes, minlength=len(terms)), at[np.argsort(codes, kind="stable")])

    def sequence(self) -> np.ndarray:
        """The number of the word at each position; -1 after a document."""
        order = np.full(self.starts[-1], -1, dtype=np.int64)
        order[self.places] = np.repeat(np.arange(len(self.terms)), self.counts)
        return order

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def index(docs: DataFrame, key: str, text: str, segment: int = SEGMENT) -> DataFrame:
    """The positional index of whole texts, a row per segment: keys and lengths of its documents, its terms, the numbers of
    their positions, and these as differences within each term."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text)
    many = [T.StructField(n, T.ArrayType(t)) for n, t in (("lengths", T.IntegerType()), ("terms", T.StringType()))]
    many += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("counts", "steps")]
    schema = T.StructType([T.StructField("keys", T.ArrayType(rows.schema[key].dataType)), *many])
    arrow = to_arrow_schema(schema)

    def given(keys: list, texts: list[str]) -> pa.RecordBatch:
        built = Segment.of(texts)
        steps = np.diff(built.places, prepend=0)
        heads = (np.cumsum(built.counts) - built.counts)[built.counts > 0]
        steps[heads] = built.places[heads]
        values = (keys, np.diff(built.starts) - 1, built.terms, built.counts, steps)
        columns = [pa.array([v], f.type) for v, f in zip(values, arrow)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = folded(value.as_py())
                many = found.count(" ") + 1 if found else 0
                if keys and size + many > segment:
                    yield given(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(name)
                texts.append(found)
                size += many
        if keys:
            yield given(keys, texts)

    return rows.mapInArrow(run, schema)


class Items:
    """A block of items, numbered, with the pairs of their successive words."""

    def __init__(self, texts: list[list[str]], share: float) -> None:
        self.texts, self.share = texts, share
        self.vocabulary: dict[str, int] = {}
        coded = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in t], dtype=np.int64) for t in texts]
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        count = np.maximum(self.sizes - 1, 0)
        self.item = np.repeat(np.arange(len(texts)), count)
        self.at = _repeated(np.zeros(len(texts), np.int64), count)
        pair = [c[:-1] * len(self.vocabulary) + c[1:] for c in coded]
        self.known, self.pair = np.unique(np.concatenate([np.zeros(0, np.int64), *pair]), return_inverse=True)
        self.solid = np.maximum(np.ceil(EXACT * share * self.sizes - 1e-9), 2)
        self.pairs = np.maximum(np.ceil(self.solid / 2), 1).astype(np.int64)
        self.stretch = np.array([2 * drift(n) + 1 for n in self.sizes.tolist()], dtype=np.int64)

    def found(self, segment: Segment) -> Iterator[tuple[int, int, float, float]]:
        """(document, item, matched, spanned) of the cases in a segment; each pair of a document and an item once."""
        yield from self._single(segment)
        if not len(self.known):
            return
        known = np.array([self.vocabulary.get(t, -1) for t in segment.terms] + [-1], dtype=np.int64)
        order = segment.sequence()
        codes = known[order]
        joint = np.where((codes[:-1] >= 0) & (codes[1:] >= 0), codes[:-1] * len(self.vocabulary) + codes[1:], -1)
        at = np.minimum(np.searchsorted(self.known, joint), len(self.known) - 1)
        place = np.flatnonzero((joint >= 0) & (self.known[at] == joint))
        pair, doc = at[place], segment.documents(place)
        counts = np.bincount(pair, minlength=len(self.known))
        rank = np.empty(len(self.pair), np.int64)
        by_count = np.lexsort((self.at, -counts[self.pair], self.item))
        rank[by_count] = _repeated(np.zeros(len(self.texts), np.int64), np.maximum(self.sizes - 1, 0))
        spared = (self.pairs - 1) // 2
        rare = rank >= spared[self.item]
        width = max(1, CELLS // max(1, len(segment.starts) - 1))
        for low in range(0, len(self.texts), width):
            mine = (self.item >= low) & (self.item < low + width)
            yield from self._aligned(segment, order, low, self._near(doc, pair, place, segment, low, width, mine, rare, spared))

    def _near(self, doc, pair, place, segment, low, width, mine, rare, spared) -> tuple[np.ndarray, ...]:
        """Document, item, place and item place of all pairs of words of documents and items that may be cases."""
        docs = len(segment.starts) - 1
        width = min(width, len(self.texts) - low)

        def spread(which: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
            """Pairs of a segment with the numbers of all item places that have them, in bounded portions."""
            rows = np.flatnonzero(which)
            rows = rows[np.argsort(self.pair[rows], kind="stable")]
            count = np.bincount(self.pair[rows], minlength=len(self.known))
            first = np.cumsum(count) - count
            ends = np.cumsum(count[pairs])
            begin = 0
            while begin < len(pairs):
                base = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, base + CELLS, side="right")))
                part = pairs[begin:end]
                yield slice(begin, end), count[part], rows[_repeated(first[part], count[part])]
                begin = end

        shared = np.zeros(docs * width, np.int32)
        once, _ = _distinct(doc * len(self.known) + pair)
        once_doc, once_pair = once // len(self.known), once % len(self.known)
        for part, count, rows in spread(mine & rare, once_pair):
            cells = np.repeat(once_doc[part], count) * width + self.item[rows] - low
            shared += np.bincount(cells, minlength=docs * width).astype(np.int32)
        alive = (shared.reshape(docs, width) >= (self.pairs - spared)[low : low + width]).ravel()
        kept = []
        for part, count, rows in spread(mine, pair):
            cells = np.repeat(doc[part], count) * width + self.item[rows] - low
            on = np.flatnonzero(alive[cells])
            kept.append((cells[on], np.repeat(place[part], count)[on], self.at[rows[on]]))
        cell, where, at = (np.concatenate([k[i] for k in kept]) if kept else np.zeros(0, np.int64) for i in range(3))
        if not len(cell):
            return cell, cell, where, at
        most = int(self.sizes.max()) + 1
        offset = (where - segment.starts[cell // width] - at + most) // self.stretch[cell % width + low]
        # two successive stretches of offsets hold any passage, and so do item words less than REACH apart
        many = int(offset.max()) + 2
        group = np.concatenate([cell * many + offset, cell * many + offset + 1]) * (most + REACH) + np.tile(at, 2)
        covered, _ = _distinct(np.concatenate([group, group + 1]))
        heads = np.flatnonzero(np.diff(covered, prepend=-most - REACH) > REACH + 1)
        ends = np.append(heads[1:], len(covered))
        owner = covered[heads] // (most + REACH) // many
        solid = _two_greatest(owner, ends - heads, docs * width)
        spanned = _two_greatest(owner, covered[ends - 1] - covered[heads] + 1, docs * width)
        item = np.tile(np.arange(low, low + width), docs)
        alive = (solid >= self.solid[item]) & (spanned >= self.share * self.sizes[item] - 1e-9)
        on = np.flatnonzero(alive[cell])
        on = on[np.lexsort((at[on], where[on], cell[on]))]
        return cell[on] // width, cell[on] % width + low, where[on], at[on]

    def _aligned(self, segment: Segment, order: np.ndarray, low: int, near) -> Iterator[tuple[int, int, float, float]]:
        doc, item, place, at = near
        heads = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        ends, last, text = np.append(heads[1:], len(doc)), -1, []
        for h, e in zip(heads.tolist(), ends.tolist()):
            d, k = int(doc[h]), int(item[h])
            start = int(segment.starts[d])
            if d != last:
                last, text = d, [segment.terms[c] for c in order[start : segment.starts[d + 1] - 1].tolist()]
            pairs = list(zip((place[h:e] - start).tolist(), at[h:e].tolist()))
            matched, spanned = reproduced(text, self.texts[k], self.share, DENSE, EXACT, pairs)
            if spanned:
                yield d, k, matched, spanned

    def _single(self, segment: Segment) -> Iterator[tuple[int, int, float, float]]:
        """Items of one word, straight from that word's list."""
        single = np.flatnonzero(self.sizes == 1).tolist()
        if single:
            number = {t: i for i, t in enumerate(segment.terms)}
            ends = np.cumsum(segment.counts)
            for k in single:
                i = number.get(self.texts[k][0])
                if i is not None:
                    for d in np.unique(segment.documents(segment.places[ends[i] - segment.counts[i] : ends[i]])).tolist():
                        yield d, k, 1.0, 1.0


def _blocks(items: DataFrame, key: str, text: str, block: int) -> Iterator[list[tuple[object, list[str]]]]:
    """Keys and words of items in blocks; the driver holds one block at a time. Different texts of one key stay apart."""
    now: list[tuple[object, list[str]]] = []
    size = 0
    for row in items.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull()).distinct().orderBy(key, text).toLocalIterator():
        found = folded(row[1]).split()
        if now and size + len(found) > block:
            yield now
            now, size = [], 0
        if found:
            now.append((row[0], found))
            size += len(found)
    if now:
        yield now


def leaked(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    share: float = 0.6,
    block: int = BLOCK,
    segment: int = SEGMENT,
) -> DataFrame:
    """(key, item, matched, spanned) of documents that reproduce ``share`` of an item's words in one or two passages.

    ``matched`` is the share of the item's words in the passages that are equal or misspelt, ``spanned`` the share from each
    passage's first to last word, with changed ones. A case has ``spanned`` of at least ``share`` of which ``DENSE`` is
    matched and ``EXACT`` stands in runs of two or more equal words; sentences of the same shape with other words span much
    and match less. Layout, mark-up, case, accents and punctuation don't matter.

    Every case is found: what is left out before the alignment can't fulfil these conditions. Null keys and texts, and texts
    without a word, are never cases; an item of one word is in every document with that word. Different texts under one item
    key are all looked for. Repeated items and documents give each pair once. Texts of any length are read as a whole. Empty
    tables give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [docs.schema[key], items.schema[item], T.StructField("matched", T.DoubleType()), T.StructField("spanned", T.DoubleType())]
    )
    segments = stored(index(docs, key, text, segment))
    blocks = _blocks(items, item, text, block)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return spark.createDataFrame([], schema)
    found = _looked_up(segments, first, share, schema)
    if second is not None:  # each further block is written before the next one is read
        folder = f"{shared_folder(spark)}/leaks-{uuid.uuid4().hex}"
        found.write.parquet(folder)
        for more in chain([second], blocks):
            _looked_up(segments, more, share, schema).write.mode("append").parquet(folder)
        found = spark.read.schema(schema).parquet(folder)
    return found.groupBy(key, item).agg(F.max("matched").alias("matched"), F.max("spanned").alias("spanned"))


def _looked_up(segments: DataFrame, block: list[tuple[object, list[str]]], share: float, schema: T.StructType) -> DataFrame:
    """The cases of one block of items in all segments; a document or item that is there twice may give a pair twice."""
    arrow = to_arrow_schema(schema)
    names, texts = [k for k, _ in block], [t for _, t in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts, share)
        for batch in batches:
            for row in range(batch.num_rows):
                keys, lengths, terms, counts, steps = (batch.column(i)[row].values for i in range(5))
                lengths, counts, steps = (x.to_numpy().astype(np.int64) for x in (lengths, counts, steps))
                heads = np.cumsum(counts) - counts
                sums = np.cumsum(steps)
                places = sums - np.repeat(sums[heads] - steps[heads], counts) if len(steps) else sums
                cases = list(items.found(Segment(lengths, terms.to_pylist(), counts, places)))
                d, k, matched, spanned = zip(*cases) if cases else ((), (), (), ())
                columns = [
                    keys.take(pa.array(d, pa.int64())),
                    pa.array([names[x] for x in k], arrow.field(1).type),
                    pa.array(matched, pa.float64()),
                    pa.array(spanned, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return segments.mapInArrow(run, schema)
