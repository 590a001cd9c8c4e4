"""Name functions on the cases that reports of earlier runs ask for, and against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from weftgraph.functions import names as N
from weftgraph.functions import sql as S

NAMES = [
    "AgentCF", "AgentCF++", "ETT", "ETT%", "Transformer", "Transformers", "TTR", "Time to Recover", "Sentence-BERT", "SBERT",
    "R@10", "Recall@10", "", "---", "Café Modèles", "Policies", "Classes", "Boxes", "Analysis", "C#", "LLM", "Large Language Model",
    "Losses", "bus", "Metrics 2", "Ties", "University of the Arts",
]


def test_columns_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE names (name VARCHAR)")
    con.executemany("INSERT INTO names VALUES (?)", [[n] for n in NAMES])
    sql = con.execute(f"SELECT name, {S.norm_key('name')}, list_sort({S.stem_set('name')}), {S.initials('name')} FROM names ORDER BY name").fetchall()
    name = F.col("name")
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    rows = df.select("name", N.norm_key(name), F.sort_array(N.stem_set(name)), N.initials(name)).collect()
    assert sorted(map(tuple, rows)) == [tuple(r) for r in sql]


def _pairs(spark, function, *pairs):
    df = spark.createDataFrame(list(pairs), "a string, b string")
    return [r[0] for r in df.select(function(F.col("a"), F.col("b"))).collect()]


def test_keys(spark):
    key = lambda n: spark.range(1).select(N.norm_key(F.lit(n))).first()[0]
    assert key("AgentCF") != key("AgentCF++") and key("ETT") != key("ETT%") and key("Transformers") == key("transformer")
    assert key("Café") == "caf" and key("---") == "---"
    assert [key(n) for n in ("policies", "ties", "classes", "bus", "analysis")] == ["policy", "tie", "class", "bus", "analysis"]
    same = _pairs(spark, N.acronym_like, ("SBERT", "Sentence-BERT"), ("Large Language Model", "LLM"), ("TTR", "Time to Recover"), ("LLM", "GPT"), ("a", "b"))
    assert same == [True, True, True, False, False]
    near = _pairs(spark, N.lexical_overlap, ("Graph Transformers", "graph transformer network"), ("Loss", "Gain"), ("", "Loss"))
    assert near == [True, False, False]


@pytest.mark.parametrize(("name", "keys"), [("Time to Recover", {"tr", "ttr"}), ("Sentence-BERT", {"sb", "sbert"})])
def test_abbreviations(spark, name, keys):
    df = spark.createDataFrame([(name,)], "n string")
    assert set(df.select(N.abbreviation_keys(F.col("n"))).first()[0]) == keys


def test_definitions_and_nulls(spark):
    df = spark.createDataFrame([("We use Time to Recover (TTR) and Mean Loss (ML).",), (None,)], "d string")
    found = [[(x["full"], x["acronym"]) for x in r[0]] for r in df.select(N.acronym_definitions(F.col("d"))).collect()]
    assert found[0][0][1] == "TTR" and found[1] == []
    empty = spark.createDataFrame([(None,)], "n string").select(N.norm_key(F.col("n"))).first()[0]
    assert empty is None
