"""Intervals, the ledger through failures, pending papers, stores and the stream."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weftgraph.operators.incremental import Ledger, inside, islands, merged, subtracted
from weftgraph.operators.intake import in_corpus, pending, replaced, with_status
from weftgraph.plans.lineage import numbered
from weftgraph.sources import corpus, stores
from weftgraph.plans.versions import Conflict
from weftgraph.streaming.intake import stream_intake, stream_manifest


def _numbers(df):
    return {n for r in df.collect() for n in range(r["lo"], r["hi"])}


def _ranges(spark, pairs):
    return spark.createDataFrame(pairs, "lo bigint, hi bigint")


def test_interval_arithmetic(spark):
    random.seed(7)
    for width in (7, 1 << 20):
        a = [(x, x + random.randint(0, 30)) for x in (random.randint(0, 200) for _ in range(12))]
        b = [(x, x + random.randint(0, 20)) for x in (random.randint(0, 200) for _ in range(12))]
        whole = {n for x in a for n in range(*x)}
        gone = {n for x in b for n in range(*x)}
        assert _numbers(merged(_ranges(spark, a), width)) == whole
        assert _numbers(subtracted(_ranges(spark, a), _ranges(spark, b), width)) == whole - gone
        rows = spark.createDataFrame([(n, "x", n) for n in [*range(230), 3]] + [(None, "x", 0)], "seq bigint, block string, hi bigint")
        kept = inside(rows, merged(_ranges(spark, a), width), width=width)
        assert kept.columns == rows.columns
        assert sorted(r["seq"] for r in kept.collect()) == sorted([n for n in [*range(230), 3] if n in whole])
        assert _numbers(islands(kept, width=width)) == {n for n in whole if n < 230}
    assert subtracted(_ranges(spark, []), _ranges(spark, [])).count() == 0


def test_ledger_skips_and_repeats_nothing(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rows = lambda ns: spark.createDataFrame([(n, f"r{n}") for n in ns], "seq bigint, v string")
    assert ledger.run(rows(range(5)), lambda df: df) == 0
    with pytest.raises(RuntimeError, match="boom"):
        ledger.run(rows(range(10)), lambda df: (_ for _ in ()).throw(RuntimeError("boom")))
    assert ledger.runs() == [0]
    assert ledger.run(rows([0, 1, 2, 3, 4, 7, 8]), lambda df: df) == 1
    assert ledger.run(rows(range(10)), lambda df: df) == 2  # 5, 6 and 9 came late
    assert ledger.run(rows(range(10)), lambda df: df) is None
    assert ledger.run(rows([]), lambda df: df) is None
    assert sorted(r["seq"] for r in ledger.output("seq bigint, v string").collect()) == list(range(10))
    assert {tuple(r) for r in ledger.processed().collect()} == {(0, 10)}


def test_numbering(spark):
    df = spark.createDataFrame([(f"k{i:03}", i) for i in random.sample(range(300), 300)], "k string, i int")
    rows, total = numbered(df, ["k"])
    assert total == 300 and all(r["seq"] == r["i"] for r in rows.collect())
    assert numbered(df.limit(0), ["k"])[1] == 0


def test_pending(spark, tmp_path):
    t = lambda d: datetime(2048, 1, d)
    scan = spark.createDataFrame(
        [("new", "h", t(1)), ("done", " H1", t(2)), ("done", "old", t(1)), ("done", None, t(3)), ("changed", "x", t(1)), ("open", "h", t(1)), ("nohash", None, t(1)), (None, "h", t(1)), ("open", "h", t(1))],
        "arxiv_id string, content_hash string, scanned_at timestamp",
    )
    manifest = spark.createDataFrame(
        [("done", 1, "h1 ", "INDEXED", t(2), t(2)), ("done", 1, "zz", "failed", t(1), t(9)), ("changed", 1, "y", "indexed", t(1), t(1)), ("open", 1, "h", "cleaned", t(2), t(1)), ("open", 1, "h", "indexed", t(1), t(1)), ("gone", 1, "h", None, t(1), t(1))],
        "arxiv_id string, run_no int, content_hash string, status string, recorded_at timestamp, loaded_at timestamp",
    )
    names = iter("abcdef")
    ledger = lambda: Ledger(spark, str(tmp_path / next(names)))
    found = lambda run, book: sorted(r[0] for r in book.output("arxiv_id string", [run]).collect())
    book = ledger()
    assert found(pending(scan, manifest, book), book) == ["changed", "new", "open"]
    assert pending(scan, manifest, book) is None
    more = scan.unionAll(spark.createDataFrame([("done", "old", t(4)), ("late", "h", t(1)), ("new", "H ", t(4))], scan.schema))
    with pytest.raises(RuntimeError, match="boom"):
        pending(more, manifest, book, lambda papers: (_ for _ in ()).throw(RuntimeError("boom")))
    assert found(pending(more, manifest, book), book) == ["done", "late"]  # a hash that returns is a new state
    assert pending(more, manifest, book) is None
    assert found(pending(scan, manifest, book), book) == ["done"]
    book = ledger()
    assert found(pending(scan, manifest.limit(0), book), book) == ["changed", "done", "new", "open"]
    assert pending(scan.limit(0), manifest, ledger()) is None
    odd = scan.withColumn("known_hash", F.lit(1)).withColumn("seq", F.lit("x"))
    book = ledger()
    assert found(pending(odd, manifest.withColumn("seq", F.lit(0)), book), book) == ["changed", "new", "open"]


def test_of_two_writers_one_commits(spark, tmp_path):
    rows = spark.createDataFrame([(n,) for n in range(4)], "seq bigint")
    one, two = (Ledger(spark, str(tmp_path / "ledger")) for _ in range(2))

    def overtaken(new):
        two.run(rows, lambda df: df)
        return new

    with pytest.raises(Conflict):
        one.run(rows, overtaken)
    assert one.runs() == [0] and sorted(r[0] for r in one.output("seq bigint").collect()) == [0, 1, 2, 3]
    # the number is taken between the last look and the publication
    one._runs.latest = lambda: -1
    with pytest.raises(Conflict):
        one.commit(islands(rows), rows)
    assert two.runs() == [0] and two.output("seq bigint").count() == 4


def test_a_snapshot_is_whole_at_any_time(spark, tmp_path):
    folder = str(tmp_path / "table")
    df = lambda n: spark.createDataFrame([(n,)], "n bigint")
    assert stores.snapshot_or_empty(spark, folder, "n bigint").count() == 0
    for n in range(5):
        assert stores.snapshot(df(n), folder) == n
        assert [r[0] for r in stores.snapshot_or_empty(spark, folder, "n bigint").collect()] == [n]
    with pytest.raises(Exception):  # a writer that dies leaves the old table
        stores.snapshot(df(9).select(F.raise_error(F.lit("boom"))), folder)
    assert [r[0] for r in stores.snapshot_or_empty(spark, folder, "n bigint").collect()] == [4]


def test_intake_helpers(spark):
    manifest = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "kept")], "arxiv_id string, status string")
    done = spark.createDataFrame([("a", "PROCESSED"), ("b", "failed")], "arxiv_id string, doc_status string")
    assert {tuple(r) for r in with_status(manifest, done).collect()} == {("a", "indexed"), ("b", "failed"), ("c", "kept")}
    refs = spark.createDataFrame([("a",), ("x",), (None,)], "arxiv_id string")
    assert {tuple(r) for r in in_corpus(refs, manifest).collect()} == {("a", True), ("x", False), (None, False)}
    docs = spark.createDataFrame([("d1", 1), ("d2", 1)], "doc_id string, v int")
    assert {tuple(r) for r in replaced(docs, spark.createDataFrame([("d2", 2)], docs.schema)).collect()} == {("d1", 1), ("d2", 2)}


FEED = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry>
<id>http://arxiv.org/abs/2401.00001v3</id><title>A
 title</title><author><name>X</name></author><published>2024-01-01</published><arxiv:primary_category term="cs.IR"/><category term="cs.IR"/>
</entry><entry><id>http://arxiv.org/abs/2401.00002</id><title>B</title><published>2024-01-02</published><arxiv:primary_category term="cs.CL"/></entry></feed>"""


def test_sources(spark, tmp_path):
    papers = corpus.listing(spark.createDataFrame([(FEED,), (None,)], "xml string"))
    assert [(r["arxiv_id"], r["version"], r["title"]) for r in papers.orderBy("arxiv_id").collect()] == [("2401.00001", "3", "A title"), ("2401.00002", "1", "B")]
    known = spark.createDataFrame([("2401.00002",)], "arxiv_id string")
    assert [r["arxiv_id"] for r in corpus.to_fetch(papers, known, "cs.IR", 5).collect()] == ["2401.00001"]
    (tmp_path / "b.md").write_text("two\nlines")
    (tmp_path / "a.md").write_text("one")
    found = corpus.first_papers(corpus.files(spark, str(tmp_path)), 1).collect()
    assert [(r["arxiv_id"], r["text"]) for r in found] == [("a", "one")]
    stops = tmp_path / "stop.txt"
    stops.write_text("# comment\nModel\n\n  Data \n")
    assert [r[0] for r in stores.stop_names(spark, str(stops)).collect()] == ["Model", "Data"]
    rows = stores.with_alias_defaults(spark.createDataFrame([("a", "b")], "alias string, canonical string"))
    rows.write.option("header", True).csv(str(tmp_path / "aliases"))
    assert stores.alias_csv(spark, str(tmp_path / "aliases")).first()["alias"] == "a"
    status = spark.createDataFrame([("d1", "DocStatus.PROCESSED", "x/2401.1.md", 2, ["c1", "c2"]), ("d2", "failed", None, None, None), ("d3", "processed", None, None, None)], "doc_id string, status string, file_path string, chunks_count int, chunks_list array<string>")
    assert {(r["doc_id"], r["arxiv_id"], r["chunks_count"]) for r in stores.processed_documents(status).collect()} == {("d1", "2401.1", 2), ("d3", "d3", 0)}
    chunks = spark.createDataFrame([("c1", ["k1", "k2"])], "chunk_id string, llm_cache_list array<string>")
    cache = spark.createDataFrame([("k1", None, "x"), ("k2", "c9", "y"), ("k3", None, "z")], "key string, chunk_id string, answer string")
    assert {(r["chunk_id"], r["answer"]) for r in stores.cached_answers(chunks, cache).collect()} == {("c1", "x"), ("c9", "y")}


def test_stream(spark, tmp_path):
    source, folder, checkpoint = (str(tmp_path / x) for x in ("source", "manifest", "checkpoint"))
    seen = []
    handle = lambda df, n: seen.append(sorted(r["arxiv_id"] for r in df.collect()))
    add = lambda rows: spark.createDataFrame(rows, "arxiv_id string, text string").coalesce(1).write.mode("append").parquet(source)
    add([("a", "1"), ("b", "1"), (None, "1"), ("c", None)])
    stream_intake(spark, source, folder, checkpoint, handle).awaitTermination()
    add([("a", "1"), ("b", "2"), ("d", "1")])
    stream_intake(spark, source, folder, checkpoint, handle).awaitTermination()
    assert seen == [["a", "b"], ["b", "d"]]
    add([("e", "1")])
    fail = lambda df, n: (_ for _ in ()).throw(RuntimeError("boom"))
    with pytest.raises(Exception, match="boom"):
        stream_intake(spark, source, folder, checkpoint, fail).awaitTermination()
    stream_intake(spark, source, folder, checkpoint, handle).awaitTermination()
    assert seen == [["a", "b"], ["b", "d"], ["e"]]
    rows = {r["arxiv_id"]: r for r in stream_manifest(spark, folder).collect()}
    assert set(rows) == {"a", "b", "d", "e"} and rows["b"]["previous_hash"] and {r["status"] for r in rows.values()} == {"indexed"}
