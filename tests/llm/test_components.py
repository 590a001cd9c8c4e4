"""Groups of linked names against union-find."""

import random

import pytest

from weftgraph.llm.components import linked


def _expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
    groups = {}
    for x in parent:
        groups.setdefault(find(x), []).append(x)
    return {(x, min(g)) for g in groups.values() for x in g}


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_several_levels(spark, kind):
    random.seed(1)
    edges = {
        "path": [(f"n{i:04}", f"n{i + 1:04}") for i in range(600)],
        "star": [("hub", f"leaf{i}") for i in range(600)],
        "random": [(f"r{random.randrange(800)}", f"s{random.randrange(800)}") for _ in range(600)],
    }[kind]
    random.shuffle(edges)
    df = spark.createDataFrame(edges, "a string, b string").repartition(4)
    assert {tuple(r) for r in linked(df, "a", "b", bound=150).collect()} == _expected(edges)


def test_nulls_blanks_repeats_and_order_by_code_point(spark):
    rows = [("é", "z", 1), (" z ", "Z", 1), (None, "q", 1), ("", "q", 1), ("s", " s ", 1), ("é", "z", 1), ("z", "é", 1), ("𝒳", "￮", 1)]
    df = spark.createDataFrame(rows, "a string, b string, u int")
    assert {tuple(r) for r in linked(df, "a", "b").collect()} == {("é", "Z"), ("z", "Z"), ("Z", "Z"), ("𝒳", "￮"), ("￮", "￮")}


def test_empty(spark):
    assert linked(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_forests_of_one_partition_are_united(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 8)
    try:
        for shared in "ab":  # one of them at least isn't the least by hash
            chain = ["ab", "bc", "cd", "de", "ef", "ab", "bc", "cd", f"{shared}g", "gh"]
            edges = spark.createDataFrame(spark.sparkContext.parallelize([tuple(e) for e in chain], 1), "a string, b string")
            assert sorted(tuple(r) for r in linked(edges, "a", "b", bound=8).collect()) == [(n, "a") for n in "abcdefgh"]
    finally:
        spark.conf.set(key, before)
