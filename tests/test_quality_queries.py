"""Queries on quality over small tables of their own."""

import itertools
import random

from weftgraph import quality_queries
from weftgraph.operators import decisions

ENTITIES = "entity_row bigint, name string, entity_type string, degree bigint, description string"


def test_every_name_of_a_large_key_group_is_decided_with_every_other(spark, tmp_path, monkeypatch):
    random.seed(3)
    spelt = [" ".join(c) for c in itertools.product(("graph", "Graph", "GRAPH"), ("net", "Net", "NET", "nets"))][:11]
    names = [*spelt, "Small One", "small one", "alone"]
    rows = [(i, n, random.choice(["model", "data"]), 1, "d") for i, n in enumerate(names)]
    spark.createDataFrame(rows, ENTITIES).write.parquet(str(tmp_path / "entities.parquet"))
    answers, decide = [], decisions.decide
    monkeypatch.setattr(decisions, "decide", lambda *a: answers.append(decide(*a)) or answers[-1])
    found = quality_queries.cluster_decisions(spark, str(tmp_path)).collect()
    members = [set(r["members"]) for r in answers[0].collect()]
    assert len(found) == len({r["cluster_id"] for r in found}) == len(members) and "smallone" in {r["cluster_id"] for r in found}
    assert all(len(m) <= 8 for m in members) and {n for m in members for n in m} == {*names} - {"alone"}
    assert all(any({a, b} <= m for m in members) for a, b in itertools.combinations(spelt, 2))
