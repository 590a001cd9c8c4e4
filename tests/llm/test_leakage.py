"""Leaked items against planted cases."""

import random

from weftgraph.llm.alignment import equal_pairs, passages, reproduced, words
from weftgraph.llm.leakage import leaked


def test_words():
    assert words("Re-\n// joined **Çafé's** ﬁrst, cold-start") == ["rejoined", "cafes", "first", "coldstart"]
    assert words("<em>A</em> [link](#bib.bib3) \\emph{x} a&nbsp;b T < 5 > 3") == ["a", "link", "x", "a", "b", "t", "5", "3"]
    assert words(None) == words("") == words("—!") == []


def test_passages_and_shares():
    item = [f"w{i}" for i in range(20)]
    doc = ["x"] * 5 + item[:9] + ["y"] * 30 + item[9:]
    assert sorted(p[:3] for p in passages(doc, item, equal_pairs(doc, item))) == [(0, 9, 9), (9, 20, 11)]
    assert reproduced(doc, item) == (1.0, 1.0)
    changed = [w if i % 7 else "zz" for i, w in enumerate(item)]
    matched, spanned = reproduced(changed, item)
    assert 0.8 <= matched < spanned
    assert reproduced(doc, [])[0] == 0 and reproduced([], item)[0] == 0


def _data():
    random.seed(11)
    vocabulary = [f"{a}{b}o{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnr"]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(40))) for i in range(12)]
    docs, cases = [], set()
    for d in range(120):
        text = [random.choice(vocabulary) for _ in range(random.randint(0, 300))]
        if d % 4 == 0:
            item = items[d // 4 % 12]
            ws = item[1].split()
            share = random.choice([1.0, 0.75, 0.35])
            taken = ws[: int(len(ws) * share)]
            cut = len(taken) // 2
            text = text[:30] + [w.upper() for w in taken[:cut]] + text[30:60] + taken[cut:] + text[60:]
            if share > 0.6:
                cases.add((d, item[0]))
        docs.append((d, " ".join(text) if d % 3 else "\n".join(text), "x", 0))
    return docs, items, cases


def test_operator_finds_planted_cases_in_one_block_or_many(spark):
    docs, items, cases = _data()
    odd = [(900, None, "x", 0), (901, "", "x", 0), (None, items[0][1], "x", 0), docs[0], (902, (items[3][1] + " ") + "filler " * 200_000, "x", 0)]
    df = spark.createDataFrame(docs + odd, "doc_id bigint, text string, term string, item_id int")
    it = spark.createDataFrame([*items, items[2], (50, None), (51, ""), (52, "two words"), (None, "a b c d e")], "item_id bigint, text string")
    expected = cases | {(902, 3)}
    for block in (400_000, 90):
        got = [(r["doc_id"], r["item_id"]) for r in leaked(df, it, block=block).collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    assert leaked(df.limit(0), it).count() == 0
    assert leaked(df, it.limit(0)).count() == 0


def test_a_part_is_paired_however_often_another_is_repeated():
    item = [f"w{i}" for i in range(39)]
    for copies in (1, 23, 24, 200):
        doc = [w for k in range(copies) for w in [*item[:21], *[f"x{k}"] * 12]] + item[20:]
        assert reproduced(doc, item) == (1.0, 1.0)


def test_overlapping_passages_count_their_union():
    item = [f"w{i}" for i in range(40)]
    assert reproduced(item[:20] + ["x"] * 30 + item[14:34], item) == (34 / 40, 34 / 40)
    assert reproduced(item[14:34] + ["x"] * 30 + item[:20], item) == (34 / 40, 34 / 40)
    # a word that only one of the two has right is matched
    one = [w if i != 16 else "zz" for i, w in enumerate(item)]
    assert reproduced(one[:20] + ["x"] * 30 + item[14:34], item) == (34 / 40, 34 / 40)


def test_matched_words_of_passages_are_those_of_their_bits_and_pairs_are_the_best_of_all():
    random.seed(5)
    for _ in range(150):
        item = [random.choice("abcdefghijklmnop") + "word" for _ in range(24)]
        doc = []
        for a in random.choices(range(20), k=40):
            doc += item[a : a + random.randint(2, 9)] + random.choices([*item, "zz"], k=random.randint(0, 9))
        found = passages(doc, item, equal_pairs(doc, item))
        assert all(bits.bit_count() == m and bits >> b << b == bits < 1 << e for b, e, m, _, _, bits, _ in found)
        pairs = [((p[5] | q[5]).bit_count(), len({*range(*p[:2]), *range(*q[:2])})) for p in found for q in found if p is q or p[4] <= q[3] or q[4] <= p[3]]
        matched, spanned = max(pairs, default=(0, 0))
        assert reproduced(doc, item) == (matched / 24, spanned / 24)


def test_a_dense_passage_stays_a_case_beside_loose_ones():
    item = [f"{i}" * 3 for i in range(100, 180)]
    loose = [w if i % 10 < 2 else f"x{i}" for i, w in enumerate(item)]
    assert reproduced(item[:48] + ["x"] * 30 + loose[48:], item, 0.6, 0.84) == (48 / 80, 48 / 80)
    # in one chain the loose words count as far as the rest bears them: words 0-51 with 50 matched, and 60-71 with 4
    assert reproduced(item[:48] + loose[48:], item, 0.6, 0.84) == (54 / 80, 64 / 80)
    assert reproduced(loose, item, 0.6, 0.84) == reproduced(item[:40], item, 0.6, 0.84) == (0, 0)


def _misspelt(word, n):
    return word[: n % len(word)] + ("x" if word[n % len(word)] != "x" else "y") + word[n % len(word) + 1 :]


def test_links_survive_misspelling_parts_and_several_texts_of_one_item(spark):
    random.seed(3)
    vocabulary = [a + b + c + d for a in ("bar", "kel", "mun", "tor") for b in ("da", "fi", "go") for c in ("lem", "ras", "vun") for d in ("ti", "so")]
    item, other = (random.sample(vocabulary, 25) for _ in range(2))
    docs = []
    for d in range(240):
        filler = lambda: [random.choice("zyxwvu") + str(random.randint(0, 999)) for _ in range(random.randint(20, 90))]
        kind = d // 60
        if kind == 0:  # sixteen of the words, every fourth misspelt
            part = [_misspelt(w, d) if i % 4 == 3 else w for i, w in enumerate(item[4:20])]
        elif kind == 1:  # all words, every third misspelt
            part = [_misspelt(w, d) if i % 3 == 2 else w for i, w in enumerate(item)]
        elif kind == 2:  # two passages
            part = item[:8] + filler() + item[16:25]
        else:  # the second text of the item's key, as it is
            part = other
        docs.append((d, " ".join(filler() + part + filler())))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = [(1, " ".join(item)), (1, " ".join(other)), (2, vocabulary[0]), (3, " ".join(item[:2])), (4, "barbar")]
    got = {tuple(r) for r in leaked(df, spark.createDataFrame(items, "item_id bigint, text string"), segment=2000).select("doc_id", "item_id").collect()}
    for kind in range(4):
        assert {d for d, k in got if k == 1 and d // 60 == kind} == set(range(kind * 60, kind * 60 + 60))
    texts = [(d, words(t)) for d, t in docs]
    assert {d for d, k in got if k == 2} == {d for d, t in texts if vocabulary[0] in t}
    assert {d for d, k in got if k == 3} == {d for d, t in texts if item[:2] in [t[i : i + 2] for i in range(len(t))]}
    assert not {d for d, k in got if k == 4}


def test_candidates_are_complete():
    """What the index finds is what aligning every document with every item finds, also with stock wording and small slices."""
    from weftgraph.llm import leakage

    random.seed(8)
    stock = [f"s{i}tock" for i in range(12)]
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in ("ala", "ero", "imu") for c in "klmn"]
    items = [[random.choice(vocabulary) for _ in range(random.randint(1, 30))] + stock[: random.randint(0, 12)] for _ in range(40)]
    docs = []
    for d in range(160):
        text = [random.choice(vocabulary) for _ in range(random.randint(0, 60))]
        for _ in range(random.randint(0, 3)):
            i = random.choice(items)
            low, high = sorted(random.choices(range(len(i) + 1), k=2))
            part = [_misspelt(w, d) if random.random() < 0.2 else w for w in i[low:high]]
            at = random.randint(0, len(text))
            text = text[:at] + part + text[at:]
        docs.append(text)
    expected = {(d, k) for d, t in enumerate(docs) for k, i in enumerate(items) if reproduced(t, i, 0.6, leakage.DENSE, leakage.EXACT)[1]}
    assert len(expected) > 50
    before = leakage.CELLS
    try:
        for cells in (before, 500):
            leakage.CELLS = cells
            got = [(d, k) for d, k, _, _ in leakage.Items(items, 0.6).found(leakage.Segment.of([" ".join(t) for t in docs]))]
            assert len(got) == len(set(got)) and set(got) == expected
    finally:
        leakage.CELLS = before
