"""Statistics and profiles of texts of every kind."""

import numpy as np
import pytest

from weftgraph.llm import prose
from weftgraph.llm.prose import Languages, Profiles, divergence, measure, text_statistics
from weftgraph.llm.units import label

COMMON = [("en", i + 1, w) for i, w in enumerate("the of and to in a is that for it as was with be by on not this are or from at which but".split())]

PROSE = (
    "The old harbour was quiet in the morning, and the boats lay at their ropes. A man came down to the water with a basket "
    "of fish that he had caught in the night. It was not a large catch, but he was pleased with it.\n\n"
    "On the way to the market he met a friend from the town. They spoke about the weather for a while and went on together."
)

CASES = {
    PROSE: "prose",
    PROSE.replace(". ", ".\n").replace(", ", ",\n"): "prose",
    "## A heading\n\n" + PROSE + "\n\n- one\n- two\n": "prose",
    "\n".join(f"- blue item number {i}" for i in range(20)): "list",
    "\n".join(f"{i}. red thing" for i in range(1, 20)): "list",
    "\n".join(f"row{i} | {i * 3} | {i * 7}.5 | n/a" for i in range(20)): "table",
    "\n".join(f"row{i},{i * 3},{i * 7}.5,4" for i in range(20)): "table",
    "%$ #@ {} [] ^^ ~~ !! " * 30: "noise",
    "The same sentence is here again for you. " * 20: "repeats",
}


@pytest.mark.parametrize("text", list(CASES))
def test_labels_of_the_sample(text):
    assert label(text, Languages(COMMON).sets("en")) == CASES[text]


CLAUSES = (
    "the boats lay at the quay", "a man came down to the water", "it was not a large catch", "she had been waiting for an hour", "they spoke about the weather",
    "the road to the town was wet", "nobody knew what it was for", "he put the basket on the ground", "the lamps were lit at six", "we read it by the window",
)


def _texts(kind, n, rng):
    """Texts of a kind that share no line."""
    nouns = [f"{a}{b}" for a in ("har", "lam", "bas", "win", "mar", "cor") for b in ("bour", "per", "ket", "dow", "ten")]
    for _ in range(n):
        pick = lambda k: [str(x) for x in rng.choice(nouns, k)]
        if kind == "prose":
            parts = [", and ".join(rng.choice(CLAUSES, rng.integers(1, 4))) + f" with the {pick(1)[0]} of {pick(1)[0]}" for _ in range(rng.integers(4, 12))]
            yield "".join(x.capitalize() + rng.choice([". ", ". ", ".\n", "? "]) for x in parts)
        elif kind == "list":
            yield "\n".join(f"{rng.choice(['- ', '* '])}{' '.join(pick(rng.integers(1, 5)))}" for _ in range(rng.integers(6, 30)))
        elif kind == "table":
            yield "\n".join(f"{pick(1)[0]} | {rng.integers(999)} | {rng.random():.2f} | {pick(1)[0]}" for _ in range(rng.integers(6, 30)))
        elif kind == "noise":
            yield "".join(rng.choice(list("%$#@{}[]^~!|;0a b"), rng.integers(200, 900)))
        else:
            yield (f"The {pick(1)[0]} of the {pick(1)[0]} is here for the {pick(1)[0]} again. ") * int(rng.integers(8, 30))


def test_profiles_fitted_on_a_sample_tell_other_texts_and_need_their_divergences(monkeypatch):
    rng, languages = np.random.default_rng(0), Languages(COMMON)
    kinds = ("prose", "list", "table", "noise", "repeats")
    profiles = Profiles([t for k in kinds for t in _texts(k, 60, rng)], languages)
    right = 0
    for kind in kinds:
        right += measure(list(_texts(kind, 40, rng)), languages, profiles)["profile"].count(kind)
    assert right >= 0.99 * 40 * len(kinds)
    # sentences may be of any length
    texts = list(_texts("prose", 60, rng))
    for words in (40, 80, 100, 120, 200):
        parts = " and ".join(t.replace(". ", " and ").replace(".\n", " and ").replace("? ", " and ").lower() for t in texts).split()
        long = " ".join(" ".join(parts[i : i + words]).capitalize() + "." for i in range(0, 600, words))
        assert measure([long], languages, profiles)["profile"] == ["prose"], words
    soup = " ".join(rng.permutation(" ".join(CLAUSES * 4).split()))
    assert measure([soup], languages, profiles)["profile"] != ["prose"] or soup.count(".") == 0
    monkeypatch.setattr(prose, "WEIGHTS", (0.0, 0.0, 0.0, 1e-9))
    left = sum(measure(list(_texts(k, 40, rng)), languages, profiles)["profile"].count(k) for k in kinds)
    assert left < 0.7 * 40 * len(kinds)


def test_counts():
    languages = Languages(COMMON)
    out = measure(["The re-used cat's hat.\nno end\n\n“So.”", None, "  \n", "a" * 3], languages, Profiles([], languages))
    assert out["n_words"] == [7, 0, 0, 1] and out["ended_lines"][0] == 2 / 3 and out["ended_lines"][1] is None
    assert out["mean_word_length"][0] == (3 + 2 + 4 + 3 + 1 + 3 + 2 + 3 + 2) / 7 and out["mean_word_length"][1] is None
    assert out["common_words"][0] == 1 / 7 and out["words_lang"] == ["en", None, None, None]
    assert out["symbol_ratio"][0] == 6 / 36 and out["profile"] == [None, "noise", "noise", None]


def test_divergence():
    assert divergence(np.array([[1.0, 0], [0, 1], [0, 0], [1, 1]]), np.array([[2.0, 0]])).ravel().round(4).tolist() == [0, 1, 1, 0.3113]


def test_operator(spark):
    rows = [(1, PROSE, "x"), (2, None, "x"), (3, "", "x"), (None, PROSE, "x"), (1, PROSE, "x"), (4, PROSE * 3000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, profile string")
    common = spark.createDataFrame([*COMMON, (None, 1, "x"), ("en", None, "y")], "lang string, word_rank int, word string")
    out = text_statistics(df, common).collect()
    assert len(out) == 6
    by = {r["doc_id"]: r for r in out if r["doc_id"]}
    assert by[1]["profile"] == "prose" and by[2]["profile"] == by[3]["profile"] == "noise"
    assert by[2]["n_words"] == 0 and by[2]["mean_word_length"] is None
    assert by[1]["n_words"] > 70 and by[4]["n_words"] == 3000 * by[1]["n_words"]
    assert text_statistics(df.limit(0), common).count() == 0
    assert text_statistics(df, common.limit(0)).count() == 6
