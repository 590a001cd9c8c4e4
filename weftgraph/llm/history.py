"""Checking new batches of names against everything accepted before, by an incremental inverted index.

Names are compared by their letters, up to two of which may differ, and by their digits and signs, which may not. A name of
ten letters or more is cut into five stretches; two differences spoil at most two of them, so of any three stretches of an
accepted name at least one stands in every name that denotes the same concept, moved by two places at most. The index keeps
the three rarest stretches of each name as its prefix; a batch looks up all places where such a stretch could stand in its
names, for lengths that differ by two at most. Shorter names are looked up by what is left after deleting up to two letters.
What is looked up and found is then verified. The index lives in a shared folder and grows by appended segments of postings,
each in as many buckets of the token as its size asks for. A batch reads the buckets that its tokens are in and nothing else
of the history: what it finds also tells which of its names are in the index, and how long the lists of their stretches are.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.plans.lineage import cut
from weftgraph.plans.versions import Versions

#: Most letters that may differ, stretches of a long name, postings of a long name, most letters of a short name.
EDITS, STRETCHES, KEPT, SHORT = 2, 5, 3, 9

#: Postings from which a stretch's list counts as long; shorter ones count as equally rare.
FREQUENT = 16

#: Postings for each bucket that the number of a segment's buckets aims at, and the most buckets of a segment.
BUCKET, BUCKETS = 100_000, 4096

#: Probes (of 16 bytes) that are sent to all workers at once to meet the buckets of the index they are in.
PROBES = 4_000_000

#: Segments of similar size (up to so many times the last one) that are merged when there are so many of them.
MERGED = 8

_NOT_LETTERS, _NOT_SIGNS = re.compile("[^a-z]+"), re.compile("[^0-9+%#]+")


def concept(name: str | None) -> tuple[str, str] | None:
    """Letters and, in order, digits and signs of a name; None for names without letters or digits and for ``n/a``.

    Case, accents, blanks, invisible characters, punctuation and a final plural s are left out.
    """
    if not name:
        return None
    text = name.casefold()
    if text.strip() == "n/a":
        return None
    if text.isascii():
        letters, signs = _NOT_LETTERS.sub("", text), _NOT_SIGNS.sub("", text)
    else:
        text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())
        letters = "".join(c for c in text if c.isalpha())
        signs = "".join(str(unicodedata.digit(c)) if c.isdigit() else c for c in text if c.isdigit() or c in "+%#")
    if not letters and not any(c.isdigit() for c in signs):
        return None
    if letters[-1:] == "s" and letters[-2:] != "ss" and len(letters) > 3:
        last = next((c for c in reversed(text) if c.isalnum() or c in "+%#"), "")
        if last == "s":
            letters = letters[:-1]
    return letters, signs


def with_concepts(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """(columns, letters, signs) of the rows whose name denotes a concept."""
    rows = df.select(*columns, F.col(name).alias("__name")).where("__name IS NOT NULL")
    schema = rows.drop("__name").schema.add("letters", T.StringType()).add("signs", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [concept(n) for n in batch.columns[-1].to_pylist()]
            kept = pa.array([i for i, f in enumerate(found) if f], pa.int64())
            pairs = [pa.array([f[i] for f in found if f], pa.string()) for i in (0, 1)]
            names = [*batch.schema.names[:-1], "letters", "signs"]
            yield pa.RecordBatch.from_arrays([*(c.take(kept) for c in batch.columns[:-1]), *pairs], names=names)

    return rows.mapInArrow(run, schema)


def _stretches(length: int) -> list[tuple[int, int]]:
    """Start and length of each stretch of a name of so many letters; the last ones are the longer."""
    base, more = divmod(length, STRETCHES)
    sizes = [base + (i >= STRETCHES - more) for i in range(STRETCHES)]
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def _moves(difference: int) -> list[int]:
    """How far a stretch may have moved if the lengths differ by so much, with no more edits than allowed on both sides."""
    return [d for d in range(-EDITS, EDITS + 1) if abs(d) + abs(difference - d) <= EDITS]


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _hashes(parts: np.ndarray) -> np.ndarray:
    """A number of 64 bits for each row of characters."""
    value = np.full(len(parts), 0x51ED270B, dtype=np.uint64)
    for j in range(parts.shape[1]):
        value = value * _BASE + parts[:, j] + np.uint64(1)
    return _mixed(value)


def _deletions(word: str) -> set[str]:
    """The word and what is left of it without one or two letters."""
    found = {word}
    for n in range(1, EDITS + 1):
        for gone in combinations(range(len(word)), n):
            found.add("".join(c for i, c in enumerate(word) if i not in gone))
    return found


#: What a token is to the name it is looked up for.
OTHER, WHOLE, STRETCH = range(3)


def tokens(letters: list[str], signs: list[str], probing: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of names, a token of each, and what it is: all tokens that must be looked up, or only those to index.

    To index are the tokens of short names (``WHOLE``) and the stretches of long ones in their own places (``STRETCH``).
    Tokens are hashes of a stretch, its number, the indexed name's length and its signs; equal hashes of other stretches
    only cost a verification.
    """
    owners, values, kinds = [], [], []
    by_signs: dict[str, int] = {}
    seeds = np.array([by_signs.setdefault(s, len(by_signs)) for s in signs], dtype=np.int64)
    width = max(map(len, by_signs), default=0) + 1
    table = np.zeros((len(by_signs), width), dtype=np.uint64)
    for s, i in by_signs.items():
        table[i, : len(s)] = [ord(c) for c in s]
    codes = np.full(len(by_signs), 7, dtype=np.uint64)
    for s, i in by_signs.items():
        codes[i] = _hashes(table[i : i + 1, : len(s)])[0]
    lengths = np.array([len(x) for x in letters], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        seed = codes[seeds[at]]
        if length <= SHORT + (EDITS if probing else 0):
            for i, s in zip(at.tolist(), seed):
                for rest in _deletions(letters[i]):
                    owners.append(np.array([i]))
                    kinds.append(np.array([WHOLE if length <= SHORT else OTHER], dtype=np.int8))
                    values.append(_mixed(_hashes(np.array([[ord(c) for c in rest]], dtype=np.uint64).reshape(1, -1)) ^ s))
        text = "".join(letters[i] for i in at.tolist()).encode("utf-32-le")
        chars = np.frombuffer(text, dtype=np.uint32).reshape(len(at), length).astype(np.uint64)
        for indexed in range(length - EDITS, length + EDITS + 1) if probing else (length,):
            if indexed <= SHORT:
                continue
            for number, (start, size) in enumerate(_stretches(indexed)):
                for move in _moves(length - indexed) if probing else (0,):
                    if 0 <= start + move and start + move + size <= length:
                        part = _hashes(chars[:, start + move : start + move + size])
                        owners.append(at)
                        kinds.append(np.full(len(at), STRETCH if indexed == length and not move else OTHER, dtype=np.int8))
                        values.append(_mixed(part ^ seed ^ np.uint64((indexed * STRETCHES + number + 1) * 0x632BE59BD9B4E019 % (1 << 64))))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    return np.concatenate(owners), np.concatenate(values).view(np.int64), np.concatenate(kinds)


def _with_tokens(df: DataFrame, kept: list[str], probing: bool) -> DataFrame:
    """(kept columns, token, kind) of rows with letters and signs."""
    rows = df.select(*kept, F.col("letters").alias("__l"), F.col("signs").alias("__s"))
    schema = rows.drop("__l", "__s").schema.add("token", T.LongType()).add("kind", T.ByteType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for low in range(0, big.num_rows, 4096):
                batch = big.slice(low, 4096)
                owner, value, kind = tokens(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist(), probing)
                at = pa.array(owner)
                arrays = [*(c.take(at) for c in batch.columns[: len(kept)]), pa.array(value), pa.array(kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "token", "kind"])

    return rows.mapInArrow(run, schema)


_KEY = ["letters", "signs", "batch", "record"]
_POSTINGS = "token bigint, letters string, signs string, batch bigint, record bigint, bucket int"


class NameIndex:
    """An index of accepted names in a shared folder.

    ``check`` tells for each name of a batch the least order (two numbers) of a name in the index or in the batch that
    denotes the same concept, and adds the batch. Names that are null or empty, have no letter or digit, or are ``n/a`` are
    in neither. A name whose concept is spelt the same as one in the index adds no postings. An empty batch adds nothing.
    A batch becomes part of the index by one atomic step, after which it must not be checked again.
    """

    def __init__(self, spark: SparkSession, folder: str, bucket: int = BUCKET) -> None:
        self.spark, self.folder, self.bucket = spark, folder.rstrip("/"), bucket
        self._versions = Versions(spark, f"{self.folder}/versions")

    def segments(self) -> list[tuple[str, int, int]]:
        """Folder, number of buckets and number of postings of each segment, the oldest first."""
        last = self._versions.latest()
        return [tuple(x) for x in json.loads(self._versions.read(last))] if last >= 0 else []

    def postings(self, wanted: set[int] | None = None) -> DataFrame:
        """Postings of all segments; with ``wanted`` those only whose bucket of the finest segment is one of these."""
        found = self.spark.createDataFrame([], _POSTINGS)
        for folder, buckets, _ in self.segments():
            part = self.spark.read.schema(_POSTINGS).parquet(folder)
            if wanted is not None and buckets > 1:  # numbers of buckets are powers of two
                part = part.where(F.col("bucket").isin(sorted({w % buckets for w in wanted})))
            found = found.unionByName(part)
        return found.drop("bucket")

    def _met(self, probes: DataFrame) -> DataFrame:
        """(kid, token, l, s, batch, record): postings with the tokens of ``probes`` (kid, token, kind).

        Nothing of the index is shuffled: probes are taken in as many parts by bucket as it takes for a part to be sent to all
        workers, and each part meets its own buckets only. A part that is greater all the same, as one token can be in any
        number of names, is joined by a shuffle.
        """
        finest = max((b for _, b, _ in self.segments()), default=1)
        bucket = F.pmod("token", F.lit(finest)).cast("int")
        sizes = {b: n for b, n in probes.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}  # BUCKETS rows at most
        parts = 1
        while parts < finest and sum(sizes.values()) > parts * PROBES:
            parts *= 2
        found = []
        for number in range(parts):
            wanted = {b: n for b, n in sizes.items() if b % parts == number}
            side = probes.where(F.pmod("token", F.lit(parts)) == number).select("kid", "token")
            side = F.broadcast(side) if sum(wanted.values()) <= PROBES else side
            old = self.postings(set(wanted)).withColumnsRenamed({"letters": "l", "signs": "s"})
            found.append(cut(old.join(side, "token")))  # one part after the other
        return reduce(DataFrame.unionByName, found)

    def keys(self, names: DataFrame, name: str, batch: Column, record: Column) -> DataFrame:
        """(letters, signs, batch, record): the different concepts of names and the least order of each."""
        rows = names.select(F.col(name).alias("name"), batch.cast("bigint").alias("batch"), record.cast("bigint").alias("record"))
        rows = with_concepts(rows.groupBy("name").agg(F.min(F.struct("batch", "record")).alias("o")), "name", ["o"])
        return rows.groupBy("letters", "signs").agg(F.min("o").alias("o")).select("letters", "signs", "o.*")

    def check(self, keys: DataFrame) -> DataFrame:
        """(letters, signs, batch, record): the least order of the same concept as each of ``keys``, its own if there is none.

        ``keys`` (letters, signs, batch, record) holds each concept once. Those that the index doesn't have are added to it.
        """
        # a hash that two names share costs a verification
        own = keys.select(*_KEY).withColumn("kid", F.xxhash64("letters", "signs"))
        probes = cut(_with_tokens(own, ["kid"], True))
        old = self._met(probes)
        lengths = old.groupBy("token", "kid").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.max("n").alias("n"))
        new = cut(self._prefixes(own, probes, lengths))
        size = new.count()
        here = (F.broadcast(new) if size <= PROBES // 4 else new).withColumnsRenamed({"letters": "l", "signs": "s"})
        both = old.withColumn("old", F.lit(True)).unionByName(probes.select("kid", "token").join(here, "token").withColumn("old", F.lit(False)))
        pairs = own.select("kid", "letters", "signs").join(both.drop("token"), "kid").where(
            (F.col("signs") == F.col("s"))
            & (F.abs(F.char_length("letters") - F.char_length("l")) <= EDITS)
            & (F.levenshtein("letters", "l", EDITS) >= 0)
        )
        known = F.max((F.col("letters") == F.col("l")) & F.col("old")).alias("known")
        best = cut(pairs.groupBy("letters", "signs").agg(F.min(F.struct("batch", "record")).alias("o"), known))
        fresh = new.join(best.where("known").select("letters", "signs"), ["letters", "signs"], "left_anti")
        self._append(fresh, size)
        return best.select("letters", "signs", "o.*")

    def load(self, keys: DataFrame) -> None:
        """Add ``keys`` without asking what they denote; the first ones need not be looked up."""
        if self.segments():
            self.check(keys)
        else:
            own = cut(keys.select(*_KEY).withColumn("kid", F.xxhash64("letters", "signs")))
            new = cut(self._prefixes(own, cut(_with_tokens(own, ["kid"], False)), None))
            self._append(new, new.count())

    def _prefixes(self, own: DataFrame, found: DataFrame, lengths: DataFrame | None) -> DataFrame:
        """Postings of the keys ``own`` from their tokens ``found`` (kid, token, kind): the stretches with the shortest lists in
        the index (token, n) and the batch, or all tokens of short names."""
        stretches = found.where(F.col("kind") == STRETCH).select("kid", "token")
        lists = stretches.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        if lengths is not None:
            lists = lists.unionAll(lengths.select("token", "n")).groupBy("token").agg(F.sum("n").alias("n"))
        rated = stretches.join(lists.where(F.col("n") >= FREQUENT), "token", "left").groupBy("kid").agg(
            F.sort_array(F.collect_set(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("ts")
        )  # five, or more where names share a hash, of which all are kept
        rarest = F.when(F.size("ts") > STRETCHES, F.col("ts")).otherwise(F.slice("ts", 1, KEPT))
        prefix = rated.select("kid", F.explode(rarest).alias("t")).select("kid", "t.token")
        short = found.where(F.col("kind") == WHOLE).select("kid", "token")
        return prefix.unionByName(short).join(own, "kid").select("token", *_KEY)

    def _write(self, postings: DataFrame, size: int) -> tuple[str, int, int]:
        """A segment of at most ``size`` postings."""
        buckets = min(BUCKETS, 1 << max(0, -(-size // self.bucket) - 1).bit_length())
        folder = f"{self.folder}/segments/{uuid.uuid4().hex}"
        rows = postings.select("token", *_KEY, F.pmod("token", F.lit(buckets)).cast("int").alias("bucket"))
        # large buckets become several files
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "token").write.partitionBy("bucket").parquet(folder)
        return folder, buckets, self.spark.read.schema(_POSTINGS).parquet(folder).count()

    def _append(self, postings: DataFrame, most: int) -> None:
        segments, number = self.segments(), self._versions.latest() + 1
        written = self._write(postings, most)
        if not written[2]:
            return
        segments.append(written)
        tail = list(takewhile(lambda x: x[2] <= MERGED * written[2], reversed(segments)))
        if len(tail) >= MERGED:
            union = reduce(DataFrame.unionByName, [self.spark.read.schema(_POSTINGS).parquet(f) for f, _, _ in tail])
            segments = [*segments[: -len(tail)], self._write(union, sum(n for _, _, n in tail))]
        self._versions.publish(number, json.dumps(segments))
