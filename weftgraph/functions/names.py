"""Scalar operators on entity names, as columns that stay in the JVM.

Tokenizers are ASCII on purpose: accented letters are left out of keys, as in the semantics these functions reproduce.
Null names give null; names without a token fall back to the lower-cased name where a key is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that initials may leave out.
STOP_INITIALS = ("of", "and", "for", "the", "a", "an", "in", "on", "to", "with", "via", "by")

#: Suffixes that stemming removes, in the order they are tried.
SUFFIXES = ("ations", "ation", "ings", "ing", "ers", "er", "ions", "ion", "ies", "es", "s", "e")

#: Fixed value: a full name followed by its acronym in brackets.
ACRONYM_DEFINITION = r"([A-Z][\w-]*(?:\s+[\w-]+){1,7})\s+\(([A-Z][A-Za-z0-9-]{1,11})\)"

#: Signs that carry meaning in names, and the words that stand for them in keys.
SIGN_WORDS = (("+", " plus "), ("%", " pct "), ("#", " num "))


def singular(word: Column) -> Column:
    """Without a plural ending; words of three letters or less, and words with digits, stay as they are."""
    size = F.char_length(word)

    def without(n: int) -> Column:
        return F.substring(word, F.lit(1), size - n)

    return (
        F.when((size <= 3) | ~word.rlike("^[a-z]+$"), word)
        .when(word.endswith("ies") & (size > 4), F.concat(without(3), F.lit("y")))
        .when(word.rlike("(sses|xes|ches|shes)$"), without(2))
        .when(word.endswith("s") & ~word.rlike("(ss|us|is|ics)$"), without(1))
        .otherwise(word)
    )


def _tokens(name: Column, pattern: str) -> Column:
    return F.regexp_extract_all(name, F.lit(pattern), F.lit(0))


def norm_key(name: Column) -> Column:
    """Lower-case tokens joined, the last one singular; signs that carry meaning are spelt as words."""
    for sign, word in SIGN_WORDS:
        name = F.replace(name, F.lit(sign), F.lit(word))
    lower = F.lower(name)
    words = _tokens(lower, "[a-z0-9]+")
    head = F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), "")
    return F.when(F.size(words) == 0, lower).otherwise(F.concat(head, singular(F.try_element_at(words, F.lit(-1)))))


def initials(name: Column, drop_stopwords: bool = True) -> Column:
    """First letters of the ASCII tokens, in lower case."""
    words = _tokens(name, "[A-Za-z0-9]+")
    if drop_stopwords:
        words = F.filter(words, lambda w: ~F.lower(w).isin(*STOP_INITIALS))
    return F.lower(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))


def stem(word: Column) -> Column:
    """Without the first suffix of the list that the word ends in and that leaves at least three letters."""
    result = None
    for suffix in SUFFIXES:
        fits = word.endswith(suffix) & (F.char_length(word) >= len(suffix) + 3)
        cut = F.substring(word, F.lit(1), F.char_length(word) - len(suffix))
        result = F.when(fits, cut) if result is None else result.when(fits, cut)
    return result.otherwise(word)


def word_set(name: Column) -> Column:
    """Different singular tokens of at least two characters."""
    words = F.filter(_tokens(F.lower(name), "[a-z0-9]+"), lambda w: F.char_length(w) > 1)
    return F.array_distinct(F.transform(words, singular))


def stem_set(name: Column) -> Column:
    """Different stems of the words of a name."""
    return F.array_distinct(F.transform(word_set(name), stem))


def abbreviation_keys(name: Column) -> Column:
    """Initials with and without stop words, and with capitalised words kept whole; at least two characters each."""
    words = _tokens(name, "[A-Za-z0-9]+")
    kept = F.transform(
        words,
        lambda w: F.when(w.rlike("[A-Z]") & ~w.rlike("[a-z]") & (F.char_length(w) > 1), F.lower(w)).otherwise(
            F.lower(F.substring(w, 1, 1))
        ),
    )
    keys = F.array(initials(name, True), initials(name, False), F.array_join(kept, ""))
    return F.filter(F.array_distinct(keys), lambda k: F.char_length(k) >= 2)


def acronym_forms(name: Column) -> Column:
    """What a name can stand for as an acronym: compact and capitals only; empty unless it is one token with two capitals."""
    caps = F.regexp_replace(name, "[^A-Z]", "")
    compact = F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))
    single = ~F.trim(name).contains(" ") & (F.char_length(caps) >= 2)
    return F.when(single, F.array_distinct(F.array(compact, F.lower(caps)))).otherwise(F.array().cast("array<string>"))


def many_worded(name: Column) -> Column:
    """Whether a name has two words or a hyphen, so that an acronym may stand for it."""
    return F.trim(name).rlike(r"\S\s+\S") | name.contains("-")


def acronym_like(a: Column, b: Column) -> Column:
    """Whether one of two names spells the initials of the other."""

    def spells(x: Column, y: Column) -> Column:
        return many_worded(y) & F.arrays_overlap(acronym_forms(x), abbreviation_keys(y))

    return spells(a, b) | spells(b, a)


def lexical_overlap(a: Column, b: Column) -> Column:
    """Whether the stems of one name are among the other's, or at least half of all stems are common; false without stems."""
    x, y = stem_set(a), stem_set(b)
    common = F.size(F.array_intersect(x, y))
    contained = (common == F.size(x)) | (common == F.size(y))
    return (F.size(x) > 0) & (F.size(y) > 0) & (contained | (common * 2 >= F.size(F.array_union(x, y))))


def acronym_definitions(text: Column) -> Column:
    """All (full name, acronym) pairs that a text defines, as structs; null text has none."""
    full = F.regexp_extract_all(text, F.lit(ACRONYM_DEFINITION), F.lit(1))
    short = F.regexp_extract_all(text, F.lit(ACRONYM_DEFINITION), F.lit(2))
    pairs = F.zip_with(full, short, lambda x, y: F.struct(F.trim(x).alias("full"), y.alias("acronym")))
    return F.coalesce(pairs, F.array().cast("array<struct<full:string,acronym:string>>"))
