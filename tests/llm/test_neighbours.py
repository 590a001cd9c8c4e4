"""Neighbours against brute force, and vectors that can't be searched."""

import numpy as np

from weftgraph.llm import neighbours
from weftgraph.llm.neighbours import COPIES, nearest, traverse


def test_traversal_is_by_sum():
    rng = np.random.default_rng(0)
    a, b = rng.random(9), rng.random(7)
    found = traverse(a, b, 0.9)
    sums = [a[i] + b[j] for i, j in found]
    assert sums == sorted(sums) and len(found) == len(set(found))
    assert set(found) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= 0.9}


def _brute(rows, k, least):
    rows = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows]
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    sims, out = np.round(m @ m.T, 7), set()
    for r in range(len(ids)):
        order = sorted((-sims[r, c], ids[c]) for c in range(len(ids)) if c != r and sims[r, c] >= least)
        out |= {(int(ids[r]), int(i)) for _, i in order[:k]}
    return out


def test_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(150, 32))
    rows = [(i, (centres[rng.integers(150)] + rng.normal(size=32) * 0.25).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, [float(x) * 3 for x in rows[5][1]]) for i in range(3)]
    odd = [(3000, None), (3001, [0.0] * 32), (3002, [1.0] * 8), (3003, [float("nan")] * 32), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id bigint, vectors array<float>, list int, part string")
    got = {(r["vec_id"], r["neighbour"]) for r in nearest(df, k=10, least=0.85).collect()}
    expected = _brute(rows, 10, 0.85)
    assert len(got & expected) >= 0.97 * len(expected) and len(got - expected) <= 0.03 * len(expected)


def test_a_dense_region_is_searched_in_blocks_and_exactly(spark, monkeypatch):
    """Near-identical vectors, nearly all of whose pairs are asked for, in small blocks, lists and portions."""
    rng = np.random.default_rng(4)
    one = rng.normal(size=24)
    rows = [(i, (one + rng.normal(size=24) * 0.02).astype(np.float32).tolist()) for i in rng.permutation(700).tolist()]
    rows += [(1000 + i, np.round(one, 1).tolist()) for i in range(30)]  # ties
    for name, value in (("BLOCK", (64, 96)), ("HELD", 3000), ("DEALT", 50), ("LIST", 150), ("QUERIES", 200)):
        monkeypatch.setattr(neighbours, name, value)
    df = spark.createDataFrame(rows, "vec_id bigint, vectors array<float>")
    got = {(r["vec_id"], r["neighbour"]) for r in nearest(df, k=10, least=0.85, recall=1.0).collect()}
    expected = _brute(rows, 10, 0.85)
    assert len(got) == len(expected) == 7300
    assert len(got & expected) >= 0.999 * len(expected)  # vectors are kept with 32 bits


def test_many_copies_empty_and_single(spark):
    rng = np.random.default_rng(2)
    one = rng.normal(size=16).tolist()
    near = (np.array(one) * 1.0 + rng.normal(size=16) * 0.01).tolist()
    rows = [(i, one) for i in range(10, 10 + COPIES + 40)] + [(1, near), (2, rng.normal(size=16).tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, vectors array<float>")
    got = {}
    for r in nearest(df, k=3, least=0.85).collect():
        got.setdefault(r["vec_id"], []).append((r["rank"], r["neighbour"]))
    assert [n for _, n in sorted(got[1])] == [10, 11, 12]
    assert [n for _, n in sorted(got[10])] == [11, 12, 13]
    assert [n for _, n in sorted(got[60])] == [10, 11, 12]
    assert 2 not in got
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 2")).count() == 0
