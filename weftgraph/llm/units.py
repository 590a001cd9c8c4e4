"""A reading of the units of a text: sentences, list items, table rows, headings, repeats and scraps.

It labels the bounded sample that the structural profiles of ``prose`` are fitted on, and is asked for nothing else. Whether
a stretch is a sentence is told by its end and its share of function words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Kinds of units.
UNITS = ("sentence", "item", "row", "repeat", "scrap", "heading")

#: Words below which, on average, units that each fill a line of their own are phrases of a list rather than sentences.
PHRASE = 8.5

#: Words from which a table's cell is a text of its own.
CELL = 15

_WORD = re.compile(r"[^\W\d_]+(?:['’‑­-][^\W\d_]+)*")
_MARKER = re.compile(r"(?:[-*•+–—▪◦‣·]|\(?\d{1,3}(?:\.\d{1,3})*[.)]|\d{1,3}(?:\.\d{1,3})+|\(?[A-Za-z][.)]|\[[ xX]?\])\s+")
_HEADING = re.compile(r"#{1,6}\s|(?:\*\*|__).{1,120}(?:\*\*|__)\s*$|={3,}|-{3,}|\*{3,}")
_QUOTE = re.compile(r"(?:>|//|\|(?=\s[^|]*$))+\s*")
_CELLS = re.compile(r"\s*\|\s*|\t+| & |(?<=\S)\s{3,}(?=\S)| {2,}(?=[-\d.]+(?:\s|$))")
_TIGHT = re.compile(r"[;,](?=\S)")
_GAPS = re.compile(r"\s+")
_LAST_NUMBER = re.compile(r"[,;]\s+[-+]?\d[\d.,%]*[.;]?$")
_LEADERS = ("....", ". . . .", "……", "____")
_SPLIT = re.compile(r"(?<=[.!?…])[\"'”’»)\]*_]*\s+(?=[\"'“‘«(\[¿¡*_]*[^\W_])")
_CLOSED = re.compile(r"[.!?…:][\"'”’»)\]*_]*$")
_SPOILT = re.compile(r"[^\W\d_][^\w\s.,'’‑­/-]+(?=[^\W\d_])|[^\W\d_]\d(?=[^\W\d_])")
_SIGNS = re.compile(r"[^\w.,;:|()'’\"“”/*-]|_")
_ODD = re.compile(r"[ÃÂâ�][^\s\w]|ï¿½|â€|�")


@dataclass
class Reading:
    """Words by kind of unit; ends: lines that end in punctuation."""

    units: dict[str, int] = field(default_factory=lambda: dict.fromkeys(UNITS, 0))
    lines: int = 0
    ended: int = 0


def _cells(line: str) -> int:
    """Columns of a line, 1 if it isn't a table row."""
    wide = tight = 1
    if "|" in line or "\t" in line or " & " in line or "  " in line:
        wide = sum(1 for c in _CELLS.split(line.strip("| \t\\")) if c.strip())
    if ("," in line or ";" in line) and (n := len(_TIGHT.findall(line))) > line.count(" ") / 2:
        tight = n + 1
    return max(wide, tight)


def _is_sentence(text: str, words: list[str], shared: int) -> bool:
    """A stretch of 5 words or more that isn't an enumeration, with not too many function words or signs that aren't words."""
    n = len(words)
    if n < 5 or shared > 0.6 * n:
        return False
    stops = text.count(";")
    marks = text.count(",") + stops
    if stops >= 4 or (marks >= 4 and marks * 4.5 > n):
        return False
    return n >= 0.55 * len(text.split()) and not any(x in text for x in _LEADERS)


def _natural(parts: list[str], words: list[list[str]], shared: list[int]) -> bool:
    """Whether a paragraph has a share of function words that sentences have; phrases and lists have less or more.

    More than half is natural only in long parts that mostly begin with a capital.
    """
    total, known = sum(map(len, words)), sum(shared)
    if not 0.08 * total <= known <= 0.58 * total:
        return False
    if known <= 0.5 * total:
        return True
    return total >= 9 * len(parts) and sum(p[:1].isupper() for p in parts) * 2 > len(parts)


def read(text: str, common: list[frozenset[str]]) -> Reading:
    """Deals the words of a text to kinds of units.

    ``common`` are the function words of its language and then of others, for paragraphs in another language.
    """
    result = Reading()
    units = result.units
    seen: set[str] = set()
    pending: list[str] = []
    alone: list[int] = []
    count = 0

    def close_paragraph(kind: str) -> None:
        nonlocal count
        if not pending:
            return
        whole = {line for line in pending if line[-1] in ".!?"}
        parts = _SPLIT.split(" ".join(pending))
        pending.clear()
        words = [_WORD.findall(p.lower()) for p in parts]
        for language in common:
            shared = [sum(map(language.__contains__, w)) for w in words]
            natural = _natural(parts, words, shared)
            if sum(shared) >= 0.08 * sum(map(len, words)):
                break
        before = False
        for i, part in enumerate(parts):
            n = len(words[i])
            if n >= 3:
                key = " ".join(part.lower().split())
                if key in seen:
                    units["repeat"] += n
                    continue
                seen.add(key)
            closed = natural and (_CLOSED.search(part[-6:]) or (before and n <= 40))
            if closed and (kind == "scrap" or n >= 10) and _is_sentence(part, words[i], shared[i]):
                units["sentence"] += n
                before = True
                count += 1
                if part in whole:
                    alone.append(n)
            else:
                units[kind] += n or len(part.split())

    kind = "scrap"
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            close_paragraph(kind)
            kind = "scrap"
            continue
        result.lines += 1
        last = line[-1]
        result.ended += last in ".!?…:,;" or (not last.isalnum() and bool(_CLOSED.search(line[-6:])))
        if line[0] in ">/|" and (m := _QUOTE.match(line)):
            line = line[m.end() :]
            if not line:
                continue
        head = line[0]
        if head in "#*_=-" and _HEADING.match(line):
            close_paragraph(kind)
            kind = "scrap"
            units["heading"] += len(_WORD.findall(line))
            continue
        if "  " in line and len(gaps := _GAPS.findall(line)) >= 8 and len(set(gaps)) == 1:
            line = " ".join(line.split())
        if "|" in line and (texts := [c.strip() for c in line.split("|") if len(c.split()) >= CELL]):
            close_paragraph(kind)
            kind = "scrap"
            pending.extend(texts)
            continue
        cells = 3 if last in "0123456789.;" and _LAST_NUMBER.search(line) else _cells(line)
        if cells >= 3 or (cells == 2 and len(line) < 120 and not _CLOSED.search(line[-6:])):
            close_paragraph(kind)
            kind = "scrap"
            units["row"] += max(len(line.split()), cells)
            continue
        if (not head.isalpha() or line[1:2] in ".)") and (m := _MARKER.match(line)):
            close_paragraph(kind)
            kind = "item"
            line = line[m.end() :]
        pending.append(line)
    close_paragraph(kind)
    if len(alone) >= 5 and len(alone) >= 0.8 * count and sum(alone) < PHRASE * len(alone):
        units["item"] += units["sentence"]
        units["sentence"] = 0
    return result


#: The profile that a text is labelled with by its main kind of unit.
LABELS = {"item": "list", "row": "table", "repeat": "repeats", "scrap": "scraps", "heading": "scraps"}


def label(text: str, common: list[frozenset[str]]) -> str:
    """The structural profile that the units of a text speak for; ``noise`` where characters rather than words make it up."""
    words = _WORD.findall(text)
    spoilt = len(_SPOILT.findall(text)) + (0 if text.isascii() else len(_ODD.findall(text)))
    solid = "".join(text.split())
    if len(_SIGNS.findall(solid)) * 3 > len(solid) or spoilt * 8 >= max(len(words), 1):
        return "noise"
    units = read(text, common).units
    if units["sentence"] * 2 >= sum(units.values()):
        return "prose"
    return LABELS[max(LABELS, key=lambda u: units[u])]
