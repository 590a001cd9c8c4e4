"""Surviving records: ties, nulls, dependencies against brute force."""

import itertools
import random

from pyspark.sql import functions as F

from weftgraph.llm.golden import Bundle, Dependency, best_bundles
from weftgraph.llm.graph_queries import fragments, merge_names

ROWS = "key string, row bigint, name string, degree bigint, type string, n bigint, k string, g string, sum string"


def _bundles():
    tie = (-F.col("row"),)
    return [
        Bundle("name", ("name", "degree"), F.col("degree"), tie),
        Bundle("type", ("type",), F.col("n"), tie),
        Bundle("first", ("row",), F.lit(0), tie),
    ]


def test_ties_nulls_repeats_and_clashing_columns(spark):
    members = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (None, "a"), (3, "zz")], "grp bigint, key string")
    rows = spark.createDataFrame(
        [
            ("a", 1, "x", None, "t", 5, "k", "g", "s"),
            ("a", 2, "y", 7, None, None, "k", "g", "s"),
            ("b", 3, "z", 7, "u", 5, "k", "g", "s"),
            ("b", 3, "z", 7, "u", 5, "k", "g", "s"),
            (None, 4, "w", 99, "v", 99, "k", "g", "s"),
        ],
        ROWS,
    )
    found = best_bundles(members, rows, "key", "grp", _bundles()).collect()
    assert [tuple(r) for r in found] == [(1, 4, "y", 7, "t", 1)]


def test_dependencies_equal_brute_force(spark):
    random.seed(4)
    data, members = [], []
    for group in range(40):
        for i in range(random.randint(1, 7)):
            data.append((f"k{group}", len(data), random.choice("xyz"), random.randint(0, 9), random.choice(["t", "u", "v", None]), random.randint(0, 9), "k", "g", "s"))
        members.append((group, f"k{group}"))
    found = best_bundles(
        spark.createDataFrame(members, "grp bigint, key string"), spark.createDataFrame(data, ROWS), "key", "grp", _bundles()[:2], [Dependency("name", "type")]
    )
    results = {r["grp"]: r for r in found.collect()}
    for group, key in members:
        own = [r for r in data if r[0] == key]
        attested = {(r[2], r[4]) for r in own}
        best = max(a[3] + b[5] for a, b in itertools.product(own, own) if (a[2], b[4]) in attested)
        r = results[group]
        assert (r["name"], r["type"]) in attested
        assert r["degree"] + max(x[5] for x in own if x[4] == r["type"]) == best


def test_chains_and_circles_of_dependencies_equal_brute_force(spark):
    random.seed(9)
    schema = "key string, row bigint, a string, b string, c string, x bigint, y bigint, z bigint"
    data = []
    for group in range(30):
        for _ in range(random.randint(1, 6)):
            data.append((f"k{group}", len(data), *(random.choice(["p", "q", None]) for _ in range(3)), *(random.randint(0, 9) for _ in range(3))))
    members = spark.createDataFrame([(g, f"k{g}") for g in range(30)], "grp bigint, key string")
    tie = (-F.col("row"),)
    bundles = [Bundle(n, (n,), F.col(t), tie) for n, t in zip("cab", "zxy")]  # the first two are linked through the third
    for pairs in ([("a", "b"), ("b", "c")], [("a", "b"), ("b", "c"), ("c", "a")]):
        found = best_bundles(members, spark.createDataFrame(data, schema), "key", "grp", bundles, [Dependency(*p) for p in pairs])
        results = {r["grp"]: r for r in found.collect()}
        assert len(results) == 30
        for group in range(30):
            own = [dict(zip(("key", "row", "a", "b", "c", "x", "y", "z"), r)) for r in data if r[0] == f"k{group}"]
            fits = lambda v: all(any(r[p] == v[p] and r[q] == v[q] for r in own) for p, q in pairs)
            choices = [
                (x["x"] + y["y"] + z["z"], v) for x in own for y in own for z in own if fits(v := {"a": x["a"], "b": y["b"], "c": z["c"]})
            ]
            best, got = max(s for s, _ in choices), {n: results[group][n] for n in "abc"}
            assert got in [v for s, v in choices if s == best]


def test_empty_tables(spark):
    members = spark.createDataFrame([], "grp bigint, key string")
    rows = spark.createDataFrame([], ROWS)
    assert best_bundles(members, rows, "key", "grp", _bundles()).count() == 0
    assert best_bundles(members, rows, "key", "grp", _bundles()[:2], [Dependency("name", "type")]).count() == 0


def test_fragments_and_merge_names(spark):
    text = "One two three four<SEP> one TWO three four <SEP>short<SEP>a b c d e"
    df = spark.createDataFrame([(text,), (None,), ("",)], "d string")
    assert [r[0] for r in df.select(fragments(F.col("d"))).collect()] == [2, 0, 0]
    merges = spark.createDataFrame(
        [(1, " A ", ["b", None]), (1, None, ["c"]), (2, None, ["d"]), (3, "", ["e"]), (4, "f", None)], "merge_id bigint, canonical string, aliases array<string>"
    )
    assert {tuple(r) for r in merge_names(merges).collect()} == {(1, "A"), (1, "b"), (1, "c"), (4, "f")}
