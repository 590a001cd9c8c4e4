"""Packings hold everything once and fit."""

import random

from weftgraph.llm.packing import packed, plan, reduced


def test_plans_are_exact_and_tight():
    random.seed(3)
    for _ in range(60):
        capacity = random.choice([10, 50, 4096])
        counts = {}
        for _ in range(random.randint(1, 200)):
            size = random.randint(1, capacity)
            counts[size] = counts.get(size, 0) + random.choice([1, 3, 40])
        used = {}
        fillings = plan(counts, capacity)
        for f in fillings:
            assert sum(s * n for s, n in f.contents.items()) <= capacity
            for s, n in f.contents.items():
                used[s] = used.get(s, 0) + n * f.count
        assert used == counts
        rooms: list[int] = []  # first fit, greatest first
        for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            at = next((i for i, r in enumerate(rooms) if r >= s), None)
            if at is None:
                rooms.append(capacity - s)
            else:
                rooms[at] -= s
        assert sum(f.count for f in fillings) <= len(rooms) * 1.01 + 1


def test_reduction_fixes_exact_complements_and_singles():
    fixed, left = reduced({7: 2, 3: 2, 10: 1, 6: 1}, 10)
    assert not left
    assert sorted((tuple(sorted(f.contents.items())), f.count) for f in fixed) == [(((3, 1), (7, 1)), 2), (((6, 1),), 1), (((10, 1),), 1)]


def test_operator(spark):
    words = "alpha beta gamma delta ".split()
    random.seed(5)
    rows = [(i, " ".join(random.choice(words) for _ in range(random.randint(1, 40))), "x", 1) for i in range(300)]
    rows += [(900, "word " * 230, "x", 1), (901, "", "x", 1), (902, None, "x", 1), (None, "lost", "x", 1), (1, rows[1][1], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, container string, rank int")
    out = packed(df, capacity=64).collect()
    filled, pieces = {}, {}
    for r in out:
        filled[r["container"]] = filled.get(r["container"], 0) + r["n_tokens"]
        pieces.setdefault(r["doc_id"], []).append(r["n_tokens"])
    assert max(filled.values()) <= 64
    assert set(pieces) == {r[0] for r in rows} - {None}
    assert len(pieces[900]) > 1 and sorted(pieces[900])[1:] == [64] * (len(pieces[900]) - 1)
    assert all(len(v) == 1 for k, v in pieces.items() if k not in (900, 1)) and len(pieces[1]) == 2
    assert pieces[901] == pieces[902] == [0]
    assert len(filled) <= sum(map(sum, pieces.values())) / 64 * 1.05 + 2
    assert packed(df.limit(0)).count() == 0
