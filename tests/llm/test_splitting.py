"""Pieces join to their text, are short enough, overlap, and end where they may."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from weftgraph.llm.splitting import pieces, split_oversized
from weftgraph.llm.splitting_queries import section_bodies


def _check(text, parts, limit, overlap):
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    assert all(b - a <= limit for a, b in parts)
    assert all(c == b - overlap and d > b for (_, b), (c, d) in zip(parts, parts[1:]))
    assert (len(parts) > 1) == (len(text) > limit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "bc ", "\n", "\n\n", ". ", "x" * 60, "💥", "\0", "é"]), min_size=1, max_size=200), st.integers(20, 90))
def test_round_trip(parts, limit):
    text = "".join(parts)
    item, _, begin, end = pieces([text, "z", text], limit, limit // 8)
    for i in (0, 2):
        _check(text, [(a, b) for k, a, b in zip(item, begin, end) if k == i], limit, limit // 8)


def test_prefers_paragraphs():
    text = "First sentence here. Second one.\n\n" + "Third sentence follows. " * 2
    _, _, _, end = pieces([text], 60, 5)
    assert end[0] == text.index("Third")


def test_operator_with_nulls_empty_long_and_clashing_columns(spark):
    random.seed(2)
    long = " ".join("w" * random.randint(1, 9) for _ in range(200_000))
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "short", "x", 0), (4, long, "x", 0), (5, "y" * 4000, "x", 0), (5, "y" * 4000, "x", 0), (None, "n", "x", 0)]
    df = spark.createDataFrame(rows, "id bigint, body string, piece string, piece_no int")
    out = split_oversized(df, ["id"], "body").collect()
    by = {}
    for r in out:
        by.setdefault(r["id"], []).append(r)
    assert set(by) == {3, 4, 5, None}
    parts = sorted(by[4], key=lambda r: r["piece_no"])
    assert [r["piece_no"] for r in parts] == list(range(len(parts)))
    _check(long, [(r["piece_start"], r["piece_end"]) for r in parts], 1500, 150)
    assert all(long[r["piece_start"] : r["piece_end"]] == r["piece"] for r in parts)
    assert len(by[5]) == 2 * len({r["piece_no"] for r in by[5]})
    assert split_oversized(df.limit(0), ["id"], "body").count() == 0


def test_section_bodies(spark):
    papers = spark.createDataFrame(
        [("p", "# T\nbody\n\n## U\n\nmore\n", None), ("p", "# T\nbody\n\n## U\n\nmore\n", None), ("q", None, None)], "arxiv_id string, text string, cleaned_at timestamp"
    )
    sections = spark.createDataFrame(
        [("p", 1, 1, "T", 0, 3), ("p", 1, 1, "T", 0, 3), ("p", 2, 2, None, 3, 7), ("p", 3, 2, "x", 90, 99), ("q", 1, 1, "T", 0, 3), ("p", 4, 2, "x", None, 3)],
        "arxiv_id string, sec_no int, heading_level int, title string, start_line int, end_line int",
    )
    found = {(r["sec_no"], r["body"]) for r in section_bodies(papers, sections).collect()}
    assert found == {(1, "body"), (2, "more"), (3, "")}
