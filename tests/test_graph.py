"""Aliases, candidates, clusters, decisions, merging and graph cleanup on rows written for them."""

import itertools
import random

from pyspark.sql import functions as F

from weftgraph.operators import aliases, candidates, clusters, decisions, export, graph, merging, quality
from weftgraph.operators.vectors import top_neighbours


def test_alias_chains(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("t", "x"), ("u", "t"), ("s", "s")] + [(f"n{i}", f"n{i + 1}") for i in range(50)]
    table = spark.createDataFrame(rows, "alias string, canonical string")
    names = spark.createDataFrame([(n,) for n in ["a", "c", "d", "x", "y", "t", "u", "s", "n0", "n49", "q"]], "name string")
    for bound in (1000, 5):
        found = {r["name"]: r["final"] for r in aliases.resolved(table, names, bound=bound).collect()}
        assert found == {"a": "d", "c": "d", "d": "d", "x": "x", "y": "y", "t": "x", "u": "x", "s": "s", "n0": "n50", "n49": "n50", "q": "q"}
    assert aliases.resolved(table.limit(0), names).where("name <> final").count() == 0


def test_alias_table(spark):
    rows = [(1, "a", "b", "same"), (2, " a ", "c", " Same"), (3, "b", "a", "different"), (4, None, "x", "same"), (5, "", "x", "same"), (6, "p", "q", None)]
    table = spark.createDataFrame(rows, "seq bigint, alias string, canonical string, verdict string")
    assert [tuple(r) for r in aliases.canonical_of(table).collect()] == [("a", "c")]
    assert [tuple(r) for r in aliases.decided_pairs(table).collect()] == [("a", "b")]


def _nodes(spark):
    rows = [
        ("Transformer", "model", True, "x"),
        ("transformers", "model", False, "x"),
        ("Time to Recover", "metric", True, "The Big Graph (BG) and the Old Big Graph (BG) are not it."),
        ("big graph", "model", False, "x"),
        ("BG", "model", False, "x"),
        ("TTR", "metric", False, "x"),
        ("Graph Network", "model", False, "x"),
        ("Graph Networks Model", "other", True, "x"),
    ]
    return spark.createDataFrame(rows, "name string, type string, focus boolean, description string")


def test_candidates(spark):
    nodes = _nodes(spark)
    pairs = lambda df: {(r["a"], r["b"]) for r in df.collect()}
    assert pairs(candidates.key_pairs(nodes)) == {("Transformer", "transformers")}
    assert pairs(candidates.key_pairs(nodes, every=False)) == {("Transformer", "transformers")}
    assert pairs(candidates.acronym_pairs(nodes)) == {("TTR", "Time to Recover")}
    assert pairs(candidates.defined_acronyms(nodes)) == {("BG", "big graph")}
    near = spark.createDataFrame(
        [("Graph Network", "Graph Networks Model", 0.86), ("Transformer", "TTR", 0.99), ("Transformer", "Graph Network", 0.95)], "name string, neighbour string, sim double"
    )
    accepted = candidates.accepted_neighbours(near, nodes)
    assert pairs(accepted) == {("Graph Network", "Graph Networks Model"), ("Graph Network", "Transformer")}
    both = candidates.candidates({"key": candidates.key_pairs(nodes), "vector": accepted}, spark.createDataFrame([("Graph Network", "Transformer")], "a string, b string"))
    assert {(r["a"], r["kinds"]) for r in both.collect()} == {("Transformer", "key"), ("Graph Network", "vector")}


def test_components_and_cover(spark):
    random.seed(6)
    pairs = [(f"n{random.randrange(40)}", f"n{random.randrange(40)}", random.random()) for _ in range(60)] + [(f"p{i}", f"p{i + 1}", 1.0) for i in range(30)]
    df = spark.createDataFrame(pairs, "a string, b string, weight double")
    for largest in (1000, 3):
        found = {}
        for r in clusters.ego_cover(df, largest=largest).collect():
            found.setdefault((r["component"], r["cluster_no"]), set()).add(r["name"])
        assert all(len(c) <= 8 for c in found.values())
        for a, b, _ in pairs:
            assert a == b or any({a, b} <= c for c in found.values())
    by_bound = [{tuple(r) for r in clusters.components(df, bound).collect()} for bound in (1000, 5)]
    labels = dict(by_bound[0])
    assert by_bound[0] == by_bound[1]
    assert all(labels[a] == labels[b] for a, b, _ in pairs if a != b)
    assert all(labels[f"p{i}"] == "p0" for i in range(31))
    assert clusters.components(df.limit(0)).count() == 0


def test_decisions(spark):
    group = lambda canonical, *members: (canonical, list(members), None)
    rows = [
        ("x", ["a", "b", "c"], ([group("z", "a", "b", "b", "q"), group("a", "a", "c")], [("a", "a", "r")], [("a", "q")], ["c", "q"]), 7),
        ("y", ["a", "b"], None, 7),
        # a name of a rejected group is free for a later one
        ("z", ["a", "b", "c"], ([group("a", "a"), group("a", "a", "b"), (None, None, None)], [("a", "b", None)], [("b", "c"), None], None), 7),
    ]
    df = spark.createDataFrame(rows, f"cluster_id string, members array<string>, answer {decisions.ANSWER}, extra int")
    found = {r["cluster_id"]: r.asDict(recursive=True) for r in decisions.validated(df).collect()}
    nothing = {"same": [], "related": [], "different": [], "unsure": [], "rejected": 0, "extra": 7}
    assert found["x"] == {**nothing, "cluster_id": "x", "members": ["a", "b", "c"], "same": [{"canonical": None, "members": ["a", "b"], "reason": ""}], "unsure": ["c"], "rejected": 1}
    assert found["y"] == {**nothing, "cluster_id": "y", "members": ["a", "b"]}
    assert found["z"]["same"] == [{"canonical": "a", "members": ["a", "b"], "reason": ""}] and found["z"]["rejected"] == 1
    assert found["z"]["related"] == [{"from": "a", "to": "b", "relation": ""}] and found["z"]["different"] == [{"a": "b", "b": "c"}]
    nodes = spark.createDataFrame(
        [("Graph Model", "model", 3, ["d"], ["c1", "c2"], 5), ("Graph Models", "method", 1, ["e"], ["c2"], 2), ("Other", "task", 1, [], [], 0)],
        "name string, type string, papers int, fragments array<string>, source_ids array<string>, degree int",
    )
    chunks = spark.createDataFrame([("c1", "Nothing. Here graph model is. Again Graph Model."), ("c2", "The Graph Models are many.")], "chunk_id string, content string")
    shown = decisions.evidence(nodes, chunks)
    assert {r["name"]: list(r["examples"]) for r in shown.collect()} == {"Graph Model": ["Here graph model is.", "The Graph Models are many."], "Graph Models": ["The Graph Models are many."]}
    grouped = spark.createDataFrame([("c", n) for n in ("Graph Model", "Graph Models", "Other")], "cluster_id string, name string")
    asked = decisions.payloads(grouped, nodes, shown)
    answers = decisions.decide(asked, asked, decisions.RuleProvider())
    row = answers.first()
    assert row["second_look"] and row["same"][0]["members"] == ["Graph Model", "Graph Models"] and row["different"][0]["b"] == "Other"
    groups = {r["name"]: r["canonical"] for r in decisions.same_groups(answers, nodes).collect()}
    assert groups == {"Graph Model": "Graph Model", "Graph Models": "Graph Model"}
    assert {r["verdict"] for r in decisions.alias_rows(answers).collect()} == {"different"}


def test_vetoes_hold_over_chains(spark):
    schema = decisions.ANSWERS
    rows = [
        ("1", ["a", "b"], [("a", ["a", "b"], "")], [], [], [], 0, False),
        ("2", ["b", "c"], [("b", ["b", "c"], "")], [("b", "z", "part of")], [], [], 0, False),
        ("3", ["a", "c"], [], [], [("a", "c")], [], 0, False),
        ("4", ["p", "q"], [("q", ["p", "q"], "")], [], [], ["p"], 0, False),
    ]
    answers = spark.createDataFrame(rows, schema)
    nodes = spark.createDataFrame([(n, 1, 1) for n in "abcpqz"], "name string, papers int, degree int")
    assert {r["name"] for r in decisions.same_groups(answers, nodes).collect()} == {"p", "q"}
    assert {r["name"] for r in decisions.same_groups(answers, nodes, enforce=False).collect()} == {"a", "b", "c", "p", "q"}
    edges = spark.createDataFrame([("p", "q")], "src string, dst string")
    fresh = decisions.related_edges(answers, edges, nodes).collect()
    assert [(r["src"], r["dst"], r["description"]) for r in fresh] == [("b", "z", "b is part of z.")]


def test_merging_and_cleanup(spark):
    nodes = spark.createDataFrame(
        [("A", "t", ["x"], ["c1"], 2, 3), ("a", "t", ["y"], ["c2"], 1, 1), ("B", "u", ["z"], [], 1, 0)],
        "name string, type string, fragments array<string>, source_ids array<string>, papers int, degree int",
    )
    mapping = merging.code_merges(nodes)
    assert {(r["name"], r["canonical"]) for r in mapping.collect()} == {("A", "A"), ("a", "A")}
    after = {r["name"]: r for r in merging.merged_nodes(nodes, mapping).collect()}
    assert set(after) == {"A", "B"} and list(after["A"]["fragments"]) == ["x", "y"] and after["A"]["papers"] == 2
    edges = spark.createDataFrame([("A", "B", 1.0, "e"), ("B", "a", 2.0, "f"), ("a", "A", 1.0, "g")], "src string, dst string, weight double, description string")
    merged = [tuple(r) for r in merging.merged_edges(edges, mapping).collect()]
    assert merged == [("A", "B", 3.0, "e<SEP>f")]
    assert merging.merge_log(mapping, nodes, "code").first()["aliases"] == ["a"]
    stop = spark.createDataFrame([("bs",)], "name string")
    assert {r["name"] for r in graph.without_stopped(nodes, stop).collect()} == {"A", "a", "B"}
    assert {r["name"] for r in graph.without_stopped(nodes, spark.createDataFrame([("b",)], "name string")).collect()} == {"A", "a"}
    assert {r["name"] for r in graph.low_evidence(nodes).collect()} == {"B"}
    long = spark.createDataFrame([("L", [str(i) for i in range(9)]), ("S", ["1"])], "name string, fragments array<string>")
    assert [(r["name"], r["fragments"]) for r in graph.condensed(long, decisions.RuleProvider()).collect()] == [("L", 9)]
    shown = graph.hub_evidence(graph.hubs(nodes, 1), edges)
    assert shown.first()["name"] == "A" and set(shown.first()["fragments"]) == {"x", "e", "g"}
    assert graph.hub_verdicts(shown, decisions.RuleProvider()).first()["verdict"] in ("one", "several")
    records = {r["name"]: r for r in export.entity_records(nodes.withColumn("papers", F.array(F.lit("p"))).drop("degree"), edges, spark.createDataFrame([("q", "A")], "alias string, canonical string")).collect()}
    assert list(records["A"]["aliases"]) == ["q"] and list(records["B"]["neighbours"]) == ["A", "a"]


def test_vectors_in_blocks(spark):
    random.seed(9)
    rows = [(i, [random.gauss(0, 1) for _ in range(8)]) for i in range(60)] + [(90, None), (91, [0.0] * 8), (92, [1.0])]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>").repartition(3)
    some = df.where("id % 5 = 0")
    whole = {tuple(r) for r in top_neighbours(df, some, 4).collect()}
    assert whole == {tuple(r) for r in top_neighbours(df, some, 4, block=5).collect()}
    assert len(whole) == 12 * 4
    assert top_neighbours(df, some.limit(0)).count() == 0


def test_quality(spark):
    names = spark.createDataFrame([("p1", "a"), ("p1", "b"), ("p2", "a"), ("p3", "c"), (None, "z"), ("p3", None)], "paper string, name string")
    assert {tuple(r) for r in quality.new_by_batch(names, 2).collect()} == {(0, 2, 2, 2), (1, 1, 1, 1)}
    batch = spark.createDataFrame([(2, 4, 8, 4, 10, 5, 6, 0, 3, 1, 9, 3, 1)], "papers int, chunks int, entity_rows int, relation_rows int, names int, new_names int, names_in_clusters int, focus int, clusters int, second_looks int, embedded int, merged int, summaries int")
    found = quality.batch_parameters(batch).first()
    assert (found["c"], found["e"], found["p"], found["k"]) == (2.0, 2.0, None, 2.0)
    kinds = spark.createDataFrame([("Please summarise",), ("Extract entities",), (quality.GLEANING,), ("x",)], "p string").select(quality.call_kind(F.col("p")))
    assert [r[0] for r in kinds.collect()] == ["summary", "extract", "glean", "other"]


def test_pair_order_is_free(spark):
    for a, b in itertools.permutations("xy"):
        assert tuple(spark.range(1).select(*aliases.pair(F.lit(a), F.lit(b))).first()) == ("x", "y")
