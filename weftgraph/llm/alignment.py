"""Words of texts as they are compared, and the passages of a query that a text reproduces."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from functools import lru_cache
from html import unescape

_MARKS = re.compile("[\u0300-\u036f\u00ad\u200b-\u200d\u2060\ufeff]+")
_HYPHENS = re.compile("[\u2010\u2011\u2019'-]")
_BROKEN = re.compile(r"-[ \t]*\n[\s>/#*|;%]*")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]*>")
_TARGET = re.compile(r"\]\([^()\s]*\)")
_COMMAND = re.compile(r"\\[A-Za-z]+\*?(?=[{\[])")
_WORD = re.compile(r"[^\W_]+")
#: Bytes of ASCII in lower case, with blanks for all but letters and digits.
_FOLD = bytes(c if chr(c).isalnum() else 32 for c in range(128)).lower() + bytes([32]) * 128


def _rejoined(found: re.Match[str]) -> str:
    """Nothing for a hyphen and line break between two letters, and what is found anywhere else."""
    text, low, high = found.string, found.start(), found.end()
    broken = low > 0 and high < len(text) and text[low - 1].isalpha() and text[high].isalpha()
    return "" if broken else found.group()


def folded(text: str | None) -> str:
    """The words of a text in order with single blanks between them, apart from layout, mark-up, case, accents and punctuation.

    Tags, the targets of links, commands of LaTeX and character references are mark-up.
    Words broken at a line's end are joined, and so are the parts around hyphens and apostrophes, so that it doesn't matter
    which of the two a hyphen is.
    """
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub("", text)
    if "](" in text:
        text = _TARGET.sub("]", text)
    if "\\" in text:
        text = _COMMAND.sub("", text)
    if "&" in text:
        text = unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
        text = _HYPHENS.sub("-", text)
    if "-" in text:
        text = _BROKEN.sub(_rejoined, text).replace("-", "")
    text = text.replace("'", "")
    return " ".join(text.encode().translate(_FOLD).decode().split() if text.isascii() else _WORD.findall(text.lower()))


def words(text: str | None) -> list[str]:
    """The words of a text as they are compared."""
    return folded(text).split()


@lru_cache(1 << 18)
def close(a: str, b: str) -> bool:
    """Whether one word may be a misspelling of the other: at most one letter in four differs, and at most two."""
    limit = min(2, max(len(a), len(b)) // 4)
    if a == b:
        return True
    if not limit or abs(len(a) - len(b)) > limit:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1] <= limit


#: Words between two runs of equal words from which they belong to different passages.
REACH = 8

#: A stretch of a text that follows a query: first query word, past the last, matched words, first and last word of the
#: text, and as bits the query's words that are matched, and of these the ones in runs of equal words.
Passage = tuple[int, int, int, int, int, int, int]


def equal_pairs(doc: list[str], item: list[str]) -> list[tuple[int, int]]:
    """Places in both at which the same two successive words stand."""
    places: dict[tuple[str, str], list[int]] = {}
    for j in range(len(item) - 1):
        places.setdefault((item[j], item[j + 1]), []).append(j)
    return [(i, j) for i in range(len(doc) - 1) for j in places.get((doc[i], doc[i + 1]), ())]


def drift(size: int) -> int:
    """By how many words the offsets of a passage may differ from its first one, for an item of so many words."""
    return max(8, size // 8)


def passages(
    doc: list[str], item: list[str], pairs: list[tuple[int, int]], reach: int = REACH, parts: bool = False, enough: float = 0.0
) -> list[Passage]:
    """Stretches of ``doc`` that follow ``item``, from the places of ``equal_pairs`` in order.

    A stretch is a chain of runs of at least two equal words in the item's order, with at most ``reach`` words between two
    runs on either side and about as many on both, at most ``drift`` off all in all. None are given if no two match
    ``enough`` words together. Between runs, words in corresponding places match if they are equal or
    one is a misspelling of the other. With ``parts`` all successive runs of a chain are stretches too.
    """
    runs: list[tuple[int, int, int]] = []
    open_runs: dict[int, tuple[int, int, int]] = {}
    for i, j in pairs:
        run = open_runs.get(i - j)
        if run and run[0] + run[2] == i + 1:
            open_runs[i - j] = (run[0], run[1], run[2] + 1)
        else:
            if run:
                runs.append(run)
            open_runs[i - j] = (i, j, 2)
    runs += open_runs.values()
    runs.sort()
    best: list[tuple[int, int, int]] = []
    off = drift(len(item))
    begins = [r[0] for r in runs]
    longest = max((r[2] for r in runs), default=0)
    for k, (i, j, n) in enumerate(runs):
        score, source, origin = n, -1, i - j
        for p in range(bisect_left(begins, i - longest - reach), k):
            pi, pj, pn = runs[p]
            if pj >= j or pi >= i or not -2 <= i - pi - j + pj <= 2 or not -off <= i - j - best[p][2] <= off:
                continue
            cut = max(0, pi + pn - i, pj + pn - j)
            if cut >= pn or cut >= n:
                continue
            gi, gj = i + cut - pi - pn, j + cut - pj - pn
            if gi > reach or gj > reach:
                continue
            total = best[p][0] + n - cut
            if gi == gj and total + gi >= score:
                total += sum(map(close, doc[pi + pn : pi + pn + gi], item[pj + pn : pj + pn + gi]))
            if total >= score:  # of equal ones the nearest run, so that no run of equal words is left out
                score, source, origin = total, p, best[p][2]
        best.append((score, source, origin))
    chains = []
    used: set[int] = set()
    for k in sorted(range(len(runs)), key=lambda k: (-best[k][0], k)):
        chain, p = [], k
        while p >= 0 and p not in used:
            chain.append(p)
            p = best[p][1]
        if not chain or chain[0] in used or p >= 0:
            used.update(chain)
            continue
        used.update(chain)
        chains.append((best[k][0], [runs[p] for p in reversed(chain)]))
    found: list[Passage] = []
    if sum(c[0] for c in chains[:2]) < enough:
        return found
    for score, ordered in chains:
        first, last = ordered[0], ordered[-1]
        found.append((first[1], last[1] + last[2], score, first[0], last[0] + last[2], *_bits(doc, item, ordered)))
        for x in range(len(ordered) if parts else 0):
            for y in range(x + 1, len(ordered) + (x > 0)):
                first, last, (bits, solid) = ordered[x], ordered[y - 1], _bits(doc, item, ordered[x:y])
                found.append((first[1], last[1] + last[2], bits.bit_count(), first[0], last[0] + last[2], bits, solid))
    return found


def _bits(doc: list[str], item: list[str], chain: list[tuple[int, int, int]]) -> tuple[int, int]:
    """The item words that a chain of runs matches, as bits, and those in the runs themselves."""
    bits, solid, pi, pj = 0, 0, *chain[0][:2]
    for i, j, n in chain:
        cut = max(0, pi - i, pj - j)
        if i + cut - pi == j + cut - pj:
            for x in range(i + cut - pi):
                bits |= close(doc[pi + x], item[pj + x]) << pj + x
        solid |= ((1 << n - cut) - 1) << j + cut
        pi, pj = i + n, j + n
    return bits | solid, solid


def reproduced(
    doc: list[str], item: list[str], share: float = 0.0, dense: float = 0.0, exact: float = 0.0, pairs: list[tuple[int, int]] | None = None
) -> tuple[float, float]:
    """Share of the item's words that the best one or two passages of ``doc`` reproduce: matched words, and words spanned.

    Only passages and pairs count that span ``share`` of the item, of whose words ``dense`` are matched and ``exact`` stand
    in runs of at least two equal words; zeros if there are none. If no whole passages do, their parts are tried. Words that
    both passages have count once. In the document the two may stand in either order, but apart. An item of one word is
    reproduced wherever that word stands. ``pairs`` are the ``equal_pairs`` where they are known.
    """
    if not item:
        return 0.0, 0.0
    if len(item) == 1:
        return (1.0, 1.0) if item[0] in doc else (0.0, 0.0)
    pairs = equal_pairs(doc, item) if pairs is None else pairs
    least = share * len(item) - 1e-9
    whole = passages(doc, item, pairs, enough=dense * least)
    best = _best(whole, least, dense, exact)
    if dense and whole and best == (0, 0):
        best = _best(passages(doc, item, pairs, parts=True), least, dense, exact)
    return best[0] / len(item), best[1] / len(item)


def _best(found: list[Passage], least: float, dense: float, exact: float) -> tuple[int, int]:
    """Matched and spanned words of the best passage or pair that spans ``least`` words and is dense and exact.

    Of passages that match the same words only the first end and the last start are kept, as these tell whether another one
    stands apart. Passages are paired by falling matched words until no pair can match more than the best, or enough.
    """
    places: dict[tuple[int, int, int, int, int], tuple[int, int]] = {}
    for b, e, m, s, t, bits, solid in found:
        end, start = places.get((m, b, e, bits, solid), (t, s))
        places[m, b, e, bits, solid] = min(end, t), max(start, s)
    ordered = sorted(((*p, *at) for p, at in places.items()), reverse=True)

    def fits(matched: int, spanned: int, solid: int) -> bool:
        return spanned >= least and matched >= dense * spanned - 1e-9 and solid.bit_count() >= exact * spanned - 1e-9

    best = max(((m, e - b) for m, b, e, _, solid, *_ in ordered if fits(m, e - b, solid)), default=(0, 0))
    enough = dense * least - 1e-6
    for x, (m1, b1, e1, bits1, solid1, t1, s1) in enumerate(ordered):
        if 2 * m1 < max(best[0], enough):
            break
        for m2, b2, e2, bits2, solid2, t2, s2 in ordered[x + 1 :]:
            if m1 + m2 < max(best[0], enough):
                break
            if t1 <= s2 or t2 <= s1:
                both = (bits1 | bits2).bit_count(), e1 - b1 + e2 - b2 - max(0, min(e1, e2) - max(b1, b2))
                if both > best and fits(*both, solid1 | solid2):
                    best = both
    return best
