"""Queries on the entity vectors over small tables of their own."""

import tracemalloc

import duckdb
import numpy as np
import pytest

from weftgraph import table_queries
from weftgraph.operators import vectors

ENTITIES = "entity_row bigint, name string, entity_type string, degree bigint, description string"
ALIASES = "seq bigint, alias string, canonical string, verdict string, decided_on string"


def _tables(spark, folder, vectors, types=None):
    """Entities and vectors of names by id, and an alias table without rows."""
    names = [(i, f"name {i}") for i, _ in vectors]
    spark.createDataFrame([(i, n, (types or {}).get(i, "model"), 1, "d") for i, n in names], ENTITIES).write.parquet(f"{folder}/entities.parquet")
    rows = [(i, n, v) for (i, n), (_, v) in zip(names, vectors)]
    spark.createDataFrame(rows, "vec_id bigint, name string, vectors array<float>").write.parquet(f"{folder}/vectors_entities.parquet")
    spark.createDataFrame([], ALIASES).write.parquet(f"{folder}/alias_table.parquet")


def _couples(n):
    """Vectors with the ids 1 to 2 n, of which each odd one and the next point nearly the same way."""
    rng = np.random.default_rng(7)
    ways = [rng.normal(size=64) for _ in range(n)]
    return [(i, (ways[(i - 1) // 2] + rng.normal(size=64) * 0.05).astype(np.float32).tolist()) for i in range(1, 2 * n + 1)]


def test_accepted_neighbours_of_every_vector(spark, tmp_path):
    _tables(spark, tmp_path, _couples(15))
    found = {(r["a"], r["b"]) for r in table_queries.accepted_neighbours(spark, str(tmp_path)).collect() if r["sim"] > 0.9}
    assert found == {tuple(sorted((f"name {i}", f"name {i + 1}"))) for i in range(1, 30, 2)}


def test_candidate_kinds_of_every_vector(spark, tmp_path):
    _tables(spark, tmp_path, _couples(15))
    found = {(r["a"], r["b"]): r["kinds"] for r in table_queries.candidate_kinds(spark, str(tmp_path)).collect() if r["sim"] and r["sim"] > 0.9}
    assert found == {tuple(sorted((f"name {i}", f"name {i + 1}"))): "vector" for i in range(1, 30, 2)}


@pytest.mark.parametrize("groups", [1, 2, 3, 4])
def test_all_neighbours_by_groups(spark, monkeypatch, groups):
    """Crowds, copies, ties and vectors that can't be compared, in one group and in several, against brute force."""
    rng = np.random.default_rng(groups)
    ways = rng.normal(size=(40, 12))
    rows = [(int(i), (ways[rng.integers(40)] + rng.normal(size=12) * 0.3).astype(np.float32).tolist()) for i in rng.permutation(2500)]
    rows += [(5000 + i, rows[3][1]) for i in range(30)] + [(6000 + i, np.sign(rng.normal(size=12)).tolist()) for i in range(200)]
    odd = [(7000, None), (7001, [0.0] * 12), (7002, [1.0] * 5), (7003, [float("nan")] * 12), (7004, [None] + [1.0] * 11), (None, rows[0][1])]
    monkeypatch.setattr(vectors, "GROUP", -(-(len(rows) + 4) // groups))
    monkeypatch.setattr(vectors, "SAMPLE", 900)
    df = spark.createDataFrame(rows + odd, "id bigint, vector array<float>")
    got = {(r["id"], r["rank"]): (r["neighbour"], r["sim"]) for r in vectors.all_neighbours(df, 10).collect()}
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(m @ m.T, 4)
    np.fill_diagonal(sims, -9)
    expected = {}
    for r, i in enumerate(ids):
        for rank, c in enumerate(np.lexsort((ids, -sims[r]))[:10]):
            expected[(i, rank + 1)] = ids[c], sims[r, c]
    assert got == expected


def test_fewer_vectors_than_asked_for(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "id bigint, vector array<double>")
    assert [(r["id"], r["neighbour"], r["rank"]) for r in vectors.all_neighbours(df, 10).orderBy("id", "rank").collect()] == [
        (0, 1, 1), (0, 2, 2), (1, 2, 1), (1, 0, 2), (2, 1, 1), (2, 0, 2)
    ]
    assert vectors.all_neighbours(df.limit(0), 10).count() == 0


def test_memory_of_neighbours_is_bounded():
    """20,000 vectors, of which 4,000 are copies; as many queries against 2,048 vectors were 328 MB of cosines alone."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(20_000, 64)).astype(np.float32)
    rows[:4000] = rows[0]
    tracemalloc.start()
    side = vectors._Side(np.arange(20_000), rows, np.full(20_000, 0.3), 10)
    vectors._meet(side, side, np.empty(vectors.TILE[0] * vectors.TILE[1] + 8, np.float32))
    side.settle()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and side.names[5].tolist() == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]


def test_candidate_kinds_by_groups_is_as_its_sql(spark, tmp_path, monkeypatch):
    """Vectors in four groups, with copies and couples, against the query's SQL."""
    monkeypatch.setattr(vectors, "GROUP", 60)
    couples = _couples(100)
    _tables(spark, tmp_path, couples + [(300 + i, couples[3][1]) for i in range(14)])
    base = duckdb.connect()
    for name in ("entities", "vectors_entities", "alias_table"):
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = base.sql(f"SELECT a, b, sim, kinds FROM ({table_queries.ORACLES['candidate_kinds']})").fetchall()
    found = [(r["a"], r["b"], r["sim"], r["kinds"]) for r in table_queries.candidate_kinds(spark, str(tmp_path)).collect()]
    assert len(found) > 1000 and sorted(found) == sorted(expected)


def test_memory_of_tiles_is_small():
    """6,000 vectors against as many, with floors that few pairs reach; tiles of 1,024 by 2,048 took 11 MB."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(12_000, 64)).astype(np.float32)
    sides = [vectors._Side(np.arange(6000) + low, rows[low : low + 6000], np.full(6000, 0.55), 10) for low in (0, 6000)]
    tracemalloc.start()
    vectors._meet(*sides, np.empty(vectors.TILE[0] * vectors.TILE[1] + 8, np.float32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = {(i, j) for side in sides for i, names in zip(side.ids.tolist(), (side.settle(), side.names)[1].tolist()) for j in names if j >= 0}
    units = rows.astype(np.float64) / np.linalg.norm(rows.astype(np.float64), axis=1, keepdims=True)
    q, e = np.nonzero(units[:6000] @ units[6000:].T > 0.551)
    assert 0 < len(q) and {*zip(q.tolist(), (e + 6000).tolist())} <= found and {*zip((e + 6000).tolist(), q.tolist())} <= found
    assert peak < 8e6
