"""A corpus through all stages, and again with changed papers; chunks, vectors and sheets."""

import hashlib

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import export
from weftgraph.operators.chunks import chunks, packed
from weftgraph.operators.embedding import embedded, tried
from weftgraph.pipeline import _CHUNKS, _MANIFEST, Providers, Run

PAPERS = [
    ("2401.00001", "# One\n## Method\nGraph Transformer is a model by Deep Lab. It beats SBERT here.\n\n## References\n- [bib.bib1] Doe."),
    ("2401.00002", "# Two\nThe Graph Transformers are many. Deep Lab made SBERT.\n"),
    ("2401.00003", "nothing to see"),
    (None, "x"),
    ("2401.00004", None),
]


def hashed():
    """A provider of vectors from the hashes of words; made here, so that workers need not import this module."""

    class Hashed:
        def embed(self, texts):
            rows = []
            for text in texts:
                row = [0.0] * 16
                for word in text.lower().split():
                    row[hashlib.md5(word[:6].encode()).digest()[0] % 16] += 1.0
                rows.append(row)
            return rows

    return Hashed()


def test_runs(spark, tmp_path):
    folder = str(tmp_path / "run")
    run = Run(spark, folder, Providers(embedding=hashed()))
    df = spark.createDataFrame(PAPERS, "arxiv_id string, text string")
    report = run.run(df, spark.createDataFrame([("Deep Lab",)], "name string"))
    assert list(report) == ["intake", "clean", "ingest", "resolve", "clean_graph", "quality", "export"]
    assert report["intake"]["papers"] == 3 and report["clean_graph"]["stopped"] == 1
    nodes = {r["name"] for r in spark.read.parquet(f"{folder}/export/nodes").collect()}
    assert "SBERT" in nodes and len({"Graph Transformer", "The Graph Transformers", "Graph Transformers"} & nodes) >= 1 and "Deep Lab" not in nodes
    rows = spark.read.option("header", True).csv(f"{folder}/export/paper_concepts")
    assert rows.columns == ["arxiv_id", "concept", "type", "extracted_name"] and rows.where("concept = 'SBERT'").count() == 2
    assert spark.read.json(f"{folder}/export/chunks").columns == ["arxiv_id", "content", "heading", "id", "order", "tokens"]
    assert spark.read.parquet(f"{folder}/export/vectors_entities").count() >= 1
    again = Run(spark, folder, Providers(embedding=hashed()))
    again._began = 0
    again.intake(spark.createDataFrame([PAPERS[1], ("2401.00001", "# One\nNow SBERT only.")], df.schema))
    assert again.report()["intake"]["papers"] == 1
    assert {r["content"] for r in again.table("chunks", _CHUNKS).where("arxiv_id = '2401.00001'").collect()} == {"Now SBERT only."}
    states = {r["arxiv_id"]: (r["status"], r["previous_hash"] is not None) for r in again.table("manifest", _MANIFEST).collect()}
    assert states == {"2401.00001": ("indexed", True), "2401.00002": ("indexed", False), "2401.00003": ("indexed", False)}


def test_chunks(spark):
    sizes = spark.createDataFrame([([3, 3, 5, 12, 1, 9, 1],), ([],)], "n array<int>")
    assert [r[0] for r in sizes.select(packed(F.col("n"), 10)).collect()] == [[0, 0, 1, 2, 3, 3, 4], []]
    text = "intro\n\n# A\none two\n\nthree four\n\nfive six seven eight nine ten\n## B\n\n  \n## C\nlast"
    df = spark.createDataFrame([(1, text), (2, None), (None, "x"), (3, "")], "id int, text string").withColumn("ord", F.lit(9))
    found = chunks(df, "id", "text", 4).orderBy("ord").collect()
    assert [(r["ord"], r["tokens"], r["content"], r["heading"]["heading"]) for r in found] == [
        (0, 1, "intro", None), (1, 4, "one two\n\nthree four", "A"), (2, 6, "five six seven eight nine ten", "A"), (3, 1, "last", "C")
    ]
    assert found[3]["heading"]["parent_headings"] == ["A"] and len({r["chunk_id"] for r in found}) == 4


def test_embedding(spark):
    df = spark.createDataFrame([(i, f"word{i} text" if i else None) for i in range(70)], "id int, text string")
    rows = embedded(df, "id", "text", hashed(), batch=8).collect()
    assert len(rows) == 69 and all(abs(sum(x * x for x in r["vector"]) - 1) < 1e-9 for r in rows)
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok"

    assert tried(flaky, 5, waits.append) == "ok" and waits == [2.0, 4.0]
    with pytest.raises(ZeroDivisionError):
        tried(lambda: 1 / 0, 2, waits.append)


def test_exports(spark):
    near = spark.createDataFrame([(1, 2, 1, 0.9), (1, 3, 2, 0.8), (2, 1, 1, 0.9)], "id int, neighbour int, rank int, sim double")
    papers = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p"), (2, "q"), (3, "r")], "id int, paper string")
    assert tuple(export.shared_papers(near, papers).first()) == (0.75, 2)
    shown = spark.createDataFrame([(2, "t", " a  b\nc" + "d" * 500)], "neighbour int, title string, text string")
    found = export.probes(near, shown).collect()
    assert [(r["id"], r["title"], len(r["text"]), r["text"][:6]) for r in found] == [(1, "t", 420, "a b cd")]
