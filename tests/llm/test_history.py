"""The name index against comparing all pairs, at once and batch by batch."""

import random
import uuid

from pyspark.sql import functions as F

from weftgraph.llm import history as history_module
from weftgraph.llm.history import MERGED, NameIndex, _with_tokens, concept
from weftgraph.plans.lineage import cut, shared_folder


def test_concepts():
    assert concept("Sentence-BERT  Encoders") == ("sentencebertencoder", "")
    assert concept("“Ëncö­der” v2+") == ("encoderv", "2+")
    assert concept("encoder²") == ("encoder", "2")
    assert concept(" N/A ") is None and concept("++") is None and concept("") is None and concept(None) is None
    assert concept("42") == ("", "42") and concept("Glass") == ("glass", "")


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _data():
    random.seed(8)
    names = ["".join(random.choice("abcd") for _ in range(random.randint(1, 16))) + random.choice(["", "", "s", " 2", "+"]) for _ in range(120)]

    def varied(name):
        letters = list(name)
        for _ in range(random.randint(0, 3)):
            at = random.randrange(len(letters) + 1)
            letters[at : at + random.randint(0, 1)] = random.choice(["", "a", "x"])
        return "".join(letters)

    batches = [(i, i // 40, varied(random.choice(names))) for i in range(160)]
    return names, batches + [(500, 1, None), (501, 2, ""), (502, 3, "n/a"), (503, 3, "é" * 12), (504, 3, "e" * 12)]


def _expected(keys, accepted):
    out = {}
    for k in keys:
        same = [o for other, o in accepted.items() if other[1] == k[1] and _distance(other[0], k[0]) <= 2]
        if same:
            out[k] = min(same)
    return out


def _index(spark, **options):
    return NameIndex(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}", **options)


def test_one_index_and_batch_by_batch_agree_with_all_pairs(spark):
    names, batches = _data()
    history = spark.createDataFrame([(n, 1) for n in [*names, None, ""]], "name string, letters int")
    records = spark.createDataFrame(batches, "record bigint, batch bigint, name string")
    accepted = {}
    for n in names:
        accepted.setdefault(concept(n), (-1, -1))
    for record, batch, n in sorted(batches, key=lambda b: (b[1], b[0])):
        if concept(n):
            accepted.setdefault(concept(n), (batch, record))
    whole = _index(spark)
    whole.load(whole.keys(history, "name", F.lit(-1), F.lit(-1)))
    at_once = {(r[0], r[1]): (r[2], r[3]) for r in whole.check(whole.keys(records, "name", F.col("batch"), F.col("record"))).collect()}
    assert at_once == _expected({concept(b[2]) for b in batches} - {None}, accepted)
    grown = _index(spark, bucket=100)
    grown.load(grown.keys(history, "name", F.lit(-1), F.lit(-1)))
    assert grown.segments()[0][1] > 1
    for number in range(2):
        part = cut(grown.keys(records.where(F.col("batch") == number), "name", F.col("batch"), F.col("record")))
        found = grown.check(part).collect()
        assert len(found) == part.count()
        for r in found:
            best = min(o for other, o in accepted.items() if other[1] == r[1] and _distance(other[0], r[0]) <= 2)
            assert (r[2], r[3]) == best
    before = grown.segments()
    grown.check(part)
    assert grown.check(part.limit(0)).count() == 0
    grown.load(part)
    assert grown.segments() == before


def test_a_batch_reads_its_buckets_only(spark):
    """A batch's plan filters the partitions of every segment, and what it reads doesn't grow with the history."""
    random.seed(2)
    batch = spark.createDataFrame([("graph transformer networks",)], "name string")
    sizes = []
    for n in (300, 2400):
        names = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20)) for _ in range(n)]
        index = _index(spark, bucket=30)
        index.load(index.keys(spark.createDataFrame([(x,) for x in names], "name string"), "name", F.lit(-1), F.lit(-1)))
        probes = _with_tokens(index.keys(batch, "name", F.lit(0), F.lit(0)).select("letters", "signs"), [], True)
        finest = index.segments()[0][1]
        read = index.postings({r[0] % finest for r in probes.collect()})
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [bucket" in plan
        share = read.count() / (n * 3)
        assert share < 0.9
        sizes.append(read.count())
        assert index.segments()[0][1] >= n * 3 / 60
    assert sizes[1] < 3 * sizes[0]


def test_probes_in_parts_give_the_same(spark, monkeypatch):
    names, batches = _data()
    history = spark.createDataFrame([(n,) for n in names], "name string")
    records = spark.createDataFrame(batches, "record bigint, batch bigint, name string")
    results = []
    for most in (history_module.PROBES, 1500, 3):
        monkeypatch.setattr(history_module, "PROBES", most)
        index = _index(spark, bucket=200)
        index.load(index.keys(history, "name", F.lit(-1), F.lit(-1)))
        results.append({tuple(r) for r in index.check(index.keys(records, "name", F.col("batch"), F.col("record"))).collect()})
    assert results[0] == results[1] == results[2]


def test_segments_of_similar_size_are_merged(spark):
    index = _index(spark)
    for number in range(MERGED):
        name = spark.createDataFrame([(chr(97 + number) * 12,)], "name string")
        index.load(index.keys(name, "name", F.lit(number), F.lit(number)))
    assert [n for _, _, n in index.segments()] == [3 * MERGED]
    assert {r["batch"] for r in index.postings().collect()} == set(range(MERGED))
