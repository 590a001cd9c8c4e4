"""A small graph through all stages."""

from weftgraph.operators import decisions
from weftgraph.plans import stages

NODES = [
    ("Graph Transformer", "model", ["A Graph Transformer (GT) is a model."], ["c1"], ["p1.md"]),
    ("graph transformers", "model", ["It is a model."], ["c2"], ["p2.md"]),
    ("GT", "other", ["GT is short."], ["c2"], ["p2.md"]),
    ("Old Name", "model", ["x"], ["c1"], ["p1.md"]),
    ("New Name", "model", ["y"], ["c1"], ["p1.md"]),
    ("Baseline", "other", ["z"], ["c1"], ["p1.md"]),
    ("Model A", "model", ["only here"] * 9, ["c1"], ["p1.md"]),
    ("Lonely", "task", ["w"], ["c1"], ["p1.md"]),
]


def test_resolve_and_clean(spark):
    nodes = spark.createDataFrame(NODES, "name string, type string, fragments array<string>, source_ids array<string>, files array<string>")
    edges = spark.createDataFrame(
        [("GT", "Old Name", 1.0, "e"), ("Graph Transformer", "graph transformers", 1.0, "f"), ("Model A", "Baseline", 1.0, "g"), ("Model A", "GT", 1.0, "h")],
        "src string, dst string, weight double, description string",
    )
    extracted = spark.createDataFrame([("GT", "p1"), ("GT", "p2")], "name string, doc string")
    alias_rows = spark.createDataFrame([(1, "Old Name", "New Name", "same"), (2, "Lonely", "New Name", "different")], "seq bigint, alias string, canonical string, verdict string")
    seen = spark.createDataFrame([("New Name", 2), ("Baseline", 1)], "name string, n_fragments int")
    neighbours = spark.createDataFrame([("GT", "Graph Transformer", 0.95), ("Lonely", "New Name", 0.99)], "name string, neighbour string, sim double")
    chunks = spark.createDataFrame([("c1", "Here Graph Transformer is used. End."), ("c2", "A GT is short.")], "chunk_id string, content string")
    provider = decisions.RuleProvider()
    found = stages.resolve(nodes, edges, extracted, alias_rows, seen, neighbours, chunks, provider)
    names = {r["name"] for r in found.nodes.collect()}
    assert names == {"GT", "New Name", "Baseline", "Model A", "Lonely"} or names == {"Graph Transformer", "New Name", "Baseline", "Model A", "Lonely"}
    merged = (names & {"GT", "Graph Transformer"}).pop()
    links = {(r["src"], r["dst"]) for r in found.edges.collect()}
    assert (min(merged, "New Name"), max(merged, "New Name")) in links and all(a != b for a, b in links)
    assert {r["method"] for r in found.merges.collect()} == {"alias", "code", "llm"}
    stats = found.statistics.first()
    assert (stats["entities_before"], stats["entities_after"], stats["clusters"]) == (8, 5, 1)
    assert ("same", merged) in {(r["verdict"], r["canonical"]) for r in found.alias_rows.collect()}
    assert {r["name"] for r in stages.focus(found.nodes, found.seen).where("focus").collect()} == set()
    papers = spark.createDataFrame([(n, ["p1"]) for n in names], "name string, papers array<string>")
    stop = spark.createDataFrame([("baselines",)], "name string")
    clean = stages.clean_graph(found.nodes, found.edges, stop, papers, provider)
    after = {r["name"]: r for r in clean.nodes.collect()}
    assert "Baseline" not in after and "Model A (p1)" in after and len(after["Model A (p1)"]["fragments"]) == 1
    assert {r["name"] for r in clean.stopped.collect()} == {"Baseline"} and {r["name"] for r in clean.low_evidence.collect()} == {"Lonely"}
    assert clean.hubs.count() == 4 and clean.condensed.first()["name"] == "Model A (p1)"


def test_measure(spark):
    nodes = spark.createDataFrame([("a", "model"), ("b", None)], "name string, type string")
    calls = spark.createDataFrame([("s1", "extract", 4, 2), ("s2", "extract", 2, 2)], "stage string, kind string, n int, papers int")
    cache = spark.createDataFrame([("c1", "extract", "x", "entity<|#|>A<|#|>t")], "chunk_id string, cache_type string, prompt string, answer string")
    names = "papers chunks entity_rows relation_rows names new_names names_in_clusters focus clusters second_looks embedded merged summaries".split()
    counts = spark.createDataFrame([tuple(range(1, 14))], ", ".join(f"{n} int" for n in names))
    found = stages.measure(nodes, calls, cache, counts)
    assert found["calls"].first()["per_paper"] == 3.0 and not found["gate"].first()["passed"]
    assert found["gleaning"].first()["extract_names"] == 1 and found["parameters"].first()["c"] == 2.0


def test_names_of_a_key_meet_after_their_least_name_is_merged_or_decided(spark):
    rows = [("Alpha-Net", "model", 1), ("alpha net", "model", 3), ("AlphaNet", "data", 1), ("B Net", "model", 1), ("BNet", "data", 1), ("b-net", "task", 1)]
    nodes = spark.createDataFrame([(n, t, ["f"], ["c1"], [f"p{i}.md" for i in range(k)]) for n, t, k in rows], "name string, type string, fragments array<string>, source_ids array<string>, files array<string>")
    empty = lambda schema: spark.createDataFrame([], schema)
    alias_rows = spark.createDataFrame([(1, "B Net", "BNet", "different")], "seq bigint, alias string, canonical string, verdict string")
    # of the first key only the name that code merges take away is in focus
    seen = spark.createDataFrame([(n, 1) for n, _, _ in rows if n not in ("Alpha-Net", "b-net")], "name string, n_fragments int")
    found = stages.resolve(
        nodes, empty("src string, dst string, weight double, description string"), empty("name string, doc string"), alias_rows, seen,
        empty("name string, neighbour string, sim double"), empty("chunk_id string, content string"), decisions.RuleProvider(),
    )
    asked = {frozenset(r["members"]) for r in found.answers.collect()}
    assert asked == {frozenset({"AlphaNet", "alpha net"}), frozenset({"B Net", "BNet", "b-net"})}
    pairs = {(r["a"], r["b"]) for r in found.pairs.collect()}
    assert {("AlphaNet", "alpha net"), ("B Net", "b-net"), ("BNet", "b-net")} <= pairs and ("B Net", "BNet") not in pairs
