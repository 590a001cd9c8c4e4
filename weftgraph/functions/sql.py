"""DuckDB expressions for the same functions, from which the queries' SQL is put together."""

from __future__ import annotations

from weftgraph.functions.names import SIGN_WORDS, STOP_INITIALS, SUFFIXES


def singular(w: str) -> str:
    return (
        f"CASE WHEN length({w}) <= 3 OR NOT regexp_matches({w}, '^[a-z]+$') THEN {w} "
        f"WHEN {w} LIKE '%ies' AND length({w}) > 4 THEN left({w}, length({w}) - 3) || 'y' "
        f"WHEN regexp_matches({w}, '(sses|xes|ches|shes)$') THEN left({w}, length({w}) - 2) "
        f"WHEN {w} LIKE '%s' AND NOT regexp_matches({w}, '(ss|us|is|ics)$') THEN left({w}, length({w}) - 1) ELSE {w} END"
    )


def norm_key(name: str) -> str:
    for sign, word in SIGN_WORDS:
        name = f"replace({name}, '{sign}', '{word}')"
    words = f"regexp_extract_all(lower({name}), '[a-z0-9]+')"
    last = singular("x")
    tail = f"list_transform({words}[-1:], lambda x: {last})"
    return f"CASE WHEN len({words}) = 0 THEN lower({name}) ELSE array_to_string(list_concat({words}[:-2], {tail}), '') END"


def initials(name: str, drop_stopwords: bool = True) -> str:
    words = f"regexp_extract_all({name}, '[A-Za-z0-9]+')"
    if drop_stopwords:
        stop = ", ".join(f"'{w}'" for w in STOP_INITIALS)
        words = f"list_filter({words}, lambda x: lower(x) NOT IN ({stop}))"
    return f"lower(array_to_string(list_transform({words}, lambda x: left(x, 1)), ''))"


def stem(w: str) -> str:
    cases = " ".join(
        f"WHEN {w} LIKE '%{s}' AND length({w}) >= {len(s) + 3} THEN left({w}, length({w}) - {len(s)})" for s in SUFFIXES
    )
    return f"CASE {cases} ELSE {w} END"


def stem_set(name: str) -> str:
    words = f"list_filter(regexp_extract_all(lower({name}), '[a-z0-9]+'), lambda x: length(x) > 1)"
    return f"list_distinct(list_transform(list_transform({words}, lambda x: {singular('x')}), lambda x: {stem('x')}))"


def lexical_overlap(x: str, y: str) -> str:
    """On two columns of stem sets."""
    common = f"len(list_intersect({x}, {y}))"
    union = f"(len({x}) + len({y}) - {common})"
    return f"(len({x}) > 0 AND len({y}) > 0 AND ({common} = len({x}) OR {common} = len({y}) OR {common} * 2 >= {union}))"


def acronym_like(a: str, b: str) -> str:
    """Whether one of two columns of names spells the initials of the other."""

    def spells(x: str, y: str) -> str:
        capitals = f"regexp_replace({x}, '[^A-Z]', '', 'g')"
        forms = f"[lower(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g')), lower({capitals})]"
        whole = "CASE WHEN regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]') AND length(w) > 1 THEN lower(w) ELSE lower(left(w, 1)) END"
        kept = f"array_to_string(list_transform(regexp_extract_all({y}, '[A-Za-z0-9]+'), lambda w: {whole}), '')"
        keys = f"list_filter([{initials(y)}, {initials(y, False)}, {kept}], lambda k: length(k) >= 2)"
        many = f"(regexp_matches(trim({y}), '\\S\\s+\\S') OR contains({y}, '-'))"
        return f"({many} AND NOT contains(trim({x}), ' ') AND length({capitals}) >= 2 AND len(list_intersect({forms}, {keys})) > 0)"

    return f"({spells(a, b)} OR {spells(b, a)})"
