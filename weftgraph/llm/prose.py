"""Per-document text statistics, and the structural profile a text is nearest to.

A text is a sequence of tokens of a few kinds, by their classes of characters and by whether a word is a function word of the
text's language: frequent and other function words, short, capitalised and other words, numbers, line and paragraph breaks,
end marks, other marks, bars and symbols. Four distributions describe it:

- which kind of token follows which;
- its words by the stretch they are in, from one end mark or paragraph break to the next: how many words it has, which share
  of them are function words, and whether an end mark closes it;
- its words by the line they are in: how many words it has, and which share of them are function words;
- its successive five words, by whether they were there before.

Structural profiles are such distributions too, several for prose and each other kind. They are fitted on a bounded sample
whose texts are labelled by their units, and every text, of the sample or not, is of the profile with the least sum of
Jensen-Shannon divergences. Profiles of prose differ by language as its function words do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftgraph.llm.units import label

#: Documents the profiles are fitted on, about, chosen by hashes of their keys (twice as many at most), and the longest of
#: them in characters; profiles of each kind, and rounds of the fit.
SAMPLE, LONGEST, PROFILES, ROUNDS = 3_000, 100_000, 16, 8

#: Weights of the divergences over transitions, stretches, lines and repeats.
WEIGHTS = (1.0, 1.0, 1.0, 1.0)

#: Characters that are worked on at once.
PORTION = 4_000_000

#: Kinds of tokens, and how frequent a function word's rank makes it.
FREQUENT, FUNCTION, SHORT, CAPITAL, WORD, NUMBER, PARAGRAPH, LINE, END, MARK, BAR, SYMBOL = range(12)
KINDS, FREQUENT_RANK = 12, 8

#: Borders of the classes of stretches and lines by words, and of shares of function words.
STRETCHES, LINES, SHARES = (1, 3, 5, 8, 12, 18, 30, 60), (1, 3, 6, 10, 16, 30), (0.01, 0.12, 0.25, 0.4, 0.6)

#: Words of a shingle that may be there before.
SHINGLE = 5

#: Classes of characters; closing signs may follow an end mark, joining ones stand inside of words.
_LETTER, _DIGIT, _BLANK, _BREAK, _END, _MARK, _BAR, _OTHER = range(8)
_CLOSING, _JOINING = "\"'”’»)]*_", "'’‑­-"

_SIZES = (KINDS * KINDS, (len(STRETCHES) + 1) * (len(SHARES) + 1) * 2, (len(LINES) + 1) * (len(SHARES) + 1), 2)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """By code point of the basic plane: class, lower-case code point, whether upper case."""
    if not _TABLES:
        every = [chr(i) for i in range(1 << 16)]
        classes = np.full(1 << 16, _OTHER, np.uint8)
        for i, c in enumerate(every):
            if c.isalnum():
                classes[i] = _DIGIT if c.isdecimal() else _LETTER
            elif c.isspace():
                classes[i] = _BLANK
        for signs, kind in (("\n", _BREAK), (".!?…", _END), (",;:", _MARK), ("|", _BAR)):
            classes[[ord(c) for c in signs]] = kind
        lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(every)], dtype=np.uint64)
        _TABLES.extend([classes, lower, np.array([c.isupper() for c in every])])
    return _TABLES


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def _hash(word: str) -> np.uint64:
    """The number that ``Tokens`` has for a word."""
    value, power = 0, 1
    for c in word.lower():
        value = (value + (ord(c) + 1) * power) % (1 << 64)
        power = power * int(_BASE) % (1 << 64)
    return np.uint64(value)


class Languages:
    """Function words by language, from rows (lang, word_rank, word); words without a rank are not among the frequent."""

    def __init__(self, rows: list[tuple[str, int | None, str]]) -> None:
        found: dict[str, dict[str, bool]] = {}
        for lang, rank, word in rows:
            if lang is not None and word:
                words = found.setdefault(lang, {})
                words[word.lower()] = words.get(word.lower(), False) or (rank is not None and rank <= FREQUENT_RANK)
        self.names = sorted(found)
        self.words = {lang: frozenset(words) for lang, words in found.items()}
        self.tables = []
        for lang in self.names:
            hashes = np.array([_hash(w) for w in found[lang]], dtype=np.uint64)
            order = np.argsort(hashes)
            self.tables.append((hashes[order], np.array(list(found[lang].values()))[order]))

    def sets(self, first: str | None) -> list[frozenset[str]]:
        """Function words of a language and then of the others."""
        return [self.words[k] for k in sorted(self.names, key=lambda k: k != first)] or [frozenset()]


def _counts(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n)


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1e-9)


class Tokens:
    """The tokens of some texts, and what is counted of them."""

    def __init__(self, texts: list[str], languages: Languages) -> None:
        classes, lower, upper = _tables()
        n = self.n = len(texts)
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.where(code < 1 << 16, code, 0xFFFD)
        kind = classes[code]
        last = np.cumsum(lengths) - 1  # a break after each text
        owner = np.repeat(np.arange(n), lengths)
        inside = np.ones(len(code), bool)
        inside[last] = False
        self.chars = np.stack([_counts(owner[inside & (kind == k)], n) for k in range(8)], axis=1)
        self._lines(code, kind, owner, inside, last)
        # runs of letters, digits and blanks are tokens, other characters are tokens of their own
        group = np.where(kind == _BREAK, _BLANK, kind)
        begins = np.append(True, (group[1:] != group[:-1]) | (group[1:] > _BREAK))
        begins[last] = True
        begins[last[:-1] + 1] = True
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(code)))
        first, self.owner = kind[at], owner[at]
        breaks = np.append(0, np.cumsum(kind == _BREAK))
        broken = breaks[at + size] - breaks[at]
        broken[np.isin(at, last)] = 2  # a text's end ends its paragraph
        word = group[at] == _LETTER
        power = _powers(_BASE, len(code))
        inverse = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), len(code))
        sums = np.append(np.zeros(1, np.uint64), np.cumsum((lower[code] + np.uint64(1)) * power[:-1]))
        value = (sums[at + size] - sums[at]) * inverse[at]
        hits, frequent = [], []
        for hashes, often in languages.tables:
            where = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            hits.append(word & (hashes[where] == value))
            frequent.append(often[where])
        totals = np.array([_counts(self.owner[h], n) for h in hits]) if hits else np.zeros((0, n), np.int64)
        self.language = totals.argmax(axis=0) if hits else np.zeros(n, np.int64)
        self.known = totals.max(axis=0) if hits else np.zeros(n, np.int64)
        mine = self.language[self.owner]
        function = np.choose(mine, hits) if hits else np.zeros(len(at), bool)
        often = np.choose(mine, frequent) if hits else function
        token = np.select(
            [function & often, function, word & (size <= 3), word & upper[code[at]], word, first == _DIGIT],
            [FREQUENT, FUNCTION, SHORT, CAPITAL, WORD, NUMBER],
            np.select([first == _END, first == _MARK, first == _BAR, first == _OTHER, broken == 1, broken > 1], [END, MARK, BAR, SYMBOL, LINE, PARAGRAPH], -1),
        )
        joined = np.zeros(len(at), bool)
        joiner = np.isin(code[at], [ord(c) for c in _JOINING])
        joined[2:] = word[2:] & word[:-2] & joiner[1:-1] & (self.owner[2:] == self.owner[:-2])
        self.words = _counts(self.owner[word & ~joined], n)
        self.letters = _counts(self.owner[word], n, size[word])
        kept = token >= 0
        self.token, self.owner, self.value, self.word = token[kept], self.owner[kept], value[kept], word[kept]

    def _lines(self, code, kind, owner, inside, last) -> None:
        """Non-blank lines of each text, and those that end in punctuation, with closing signs behind it or not."""
        line = np.cumsum(np.append(0, (kind == _BREAK)[:-1]))
        solid = np.flatnonzero((kind != _BLANK) & (kind != _BREAK))
        ends = solid[np.append(line[solid][1:] != line[solid][:-1], True)] if len(solid) else solid
        closing = np.isin(code[ends], [ord(c) for c in _CLOSING])
        before = np.maximum(ends - 1, 0)
        ended = np.isin(kind[ends], (_END, _MARK)) | (closing & (kind[before] == _END))
        self.lines, self.ended = _counts(owner[ends], self.n), _counts(owner[ends[ended]], self.n)

    def _by_part(self, breaks: np.ndarray, borders: tuple[int, ...], closed: np.ndarray | None = None) -> np.ndarray:
        """Words of each text by the class of their part: its words, its share of function words, and whether it is closed."""
        part = np.cumsum(np.append(0, breaks[:-1]))
        count = part[-1] + 1 if len(part) else 0
        words = _counts(part[self.word], count)
        share = _shares(_counts(part[self.token <= FUNCTION], count), words)
        cls = np.digitize(words, borders) * (len(SHARES) + 1) + np.digitize(share, SHARES)
        bins = (len(borders) + 1) * (len(SHARES) + 1)
        if closed is not None:
            ended = np.zeros(count, np.int64)
            ended[part[closed]] = 1
            cls, bins = cls * 2 + ended, bins * 2
        owner = self.owner[self.word]
        return _counts(owner * bins + cls[part[self.word]], self.n * bins).reshape(self.n, bins)

    def distributions(self) -> list[np.ndarray]:
        """The four distributions, as counts."""
        token, n = self.token, self.n
        before = np.append(PARAGRAPH, token[:-1])
        before[np.append(True, self.owner[1:] != self.owner[:-1])[: len(token)]] = PARAGRAPH
        pairs = _counts(self.owner * KINDS**2 + before * KINDS + token, n * KINDS**2).reshape(n, KINDS**2)
        stretches = self._by_part((token == END) | (token == PARAGRAPH), STRETCHES, token == END)
        lines = self._by_part((token == LINE) | (token == PARAGRAPH), LINES)
        value, owner = self.value[self.word], self.owner[self.word]
        many = max(0, len(value) - SHINGLE + 1)
        shingle = np.zeros(many, np.uint64)
        for i in range(SHINGLE):
            shingle = (shingle ^ (shingle >> np.uint64(31))) * _BASE + value[i : i + many]
        whole = owner[:many] == owner[SHINGLE - 1 :] if many else np.zeros(0, bool)
        shingle, owner = shingle[whole], owner[:many][whole]
        order = np.lexsort((shingle, owner))
        shingle, owner = shingle[order], owner[order]
        again = np.append(False, (shingle[1:] == shingle[:-1]) & (owner[1:] == owner[:-1]))[: len(shingle)]
        repeats = np.stack([_counts(owner[~again], n), _counts(owner[again], n)], axis=1)
        return [pairs, stretches, lines, repeats]


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of each row of ``p`` from each row of ``q``, 0 to 1; a row of zeros is at 1."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1e-12)
    q = q / np.maximum(q.sum(axis=1, keepdims=True), 1e-12)
    row, col = np.nonzero(p)
    x = p[row, col]
    out = np.empty((len(p), len(q)))
    for j, y in enumerate(q):  # where p is 0, q counts in full
        z = y[col]
        m = x + z
        both = x * np.log2(2 * x / m) + np.where(z > 0, z * np.log2(np.where(z > 0, 2 * z / m, 1)), 0)
        out[:, j] = (np.bincount(row, both, len(p)) + y.sum() - np.bincount(row, z, len(p))) / 2
    out[p.sum(axis=1) == 0] = 1
    return out


class Profiles:
    """Several distributions of each kind of text."""

    def __init__(self, texts: list[str], languages: Languages, many: int = PROFILES, rounds: int = ROUNDS) -> None:
        self.kinds: list[str] = []
        self.centres = [np.zeros((0, size)) for size in _SIZES]
        if not texts:
            return
        tokens = Tokens(texts, languages)
        names = [languages.names[i] if k else None for i, k in zip(tokens.language, tokens.known)]
        labels = np.array([label(t, languages.sets(x)) if t.strip() else "" for t, x in zip(texts, names)], dtype=object)
        parts = [d / np.maximum(d.sum(axis=1, keepdims=True), 1e-12) for d in tokens.distributions()]
        centres: list[list[np.ndarray]] = [[] for _ in parts]
        for kind in sorted(set(labels) - {""}):
            own = [p[labels == kind] for p in parts]
            for centre, found in zip(centres, self._fit(own, many, rounds)):
                centre.append(found)
            self.kinds += [kind] * len(centres[0][-1])
        if self.kinds:
            self.centres = [np.concatenate(c) for c in centres]

    @staticmethod
    def _fit(own: list[np.ndarray], many: int, rounds: int) -> list[np.ndarray]:
        """Means of groups of texts, each text in the group of the nearest mean; fewer where groups come out empty."""
        at = np.random.default_rng(0).choice(len(own[0]), min(many, len(own[0])), replace=False)
        centres = [p[at] for p in own]
        for _ in range(rounds):
            nearest = _distances(own, centres).argmin(axis=1)
            groups = np.unique(nearest)
            centres = [np.stack([p[nearest == g].mean(axis=0) for g in groups]) for p in own]
        return centres

    def nearest(self, parts: list[np.ndarray]) -> tuple[list[str | None], np.ndarray]:
        """The kind and divergence of the nearest profile of each text; null if there are no profiles."""
        if not self.kinds:
            return [None] * len(parts[0]), np.full(len(parts[0]), np.nan)
        total = _distances(parts, self.centres)
        best = total.argmin(axis=1)
        return [self.kinds[b] for b in best], total[np.arange(len(best)), best]


def _distances(parts: list[np.ndarray], centres: list[np.ndarray]) -> np.ndarray:
    """Weighted means of the divergences of texts from profiles."""
    return sum(w * divergence(p, c) for w, p, c in zip(WEIGHTS, parts, centres)) / sum(WEIGHTS)


STATISTICS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("mean_word_length", T.DoubleType()),
        T.StructField("symbol_ratio", T.DoubleType()),
        T.StructField("ended_lines", T.DoubleType()),
        T.StructField("common_words", T.DoubleType()),
        T.StructField("sentence_words", T.DoubleType()),
        T.StructField("words_lang", T.StringType()),
        T.StructField("profile", T.StringType()),
        T.StructField("divergence", T.DoubleType()),
    ]
)

#: Stretches of five words or more with the function words of a sentence that an end mark closes.
_SENTENCES = np.zeros((len(STRETCHES) + 1, len(SHARES) + 1, 2), bool)
_SENTENCES[3:, 2:5, 1] = True


def _portions(texts: list[str]) -> Iterator[list[str]]:
    now, size = [], 0
    for text in texts:
        if now and size + len(text) > PORTION:
            yield now
            now, size = [], 0
        now.append(text)
        size += len(text)
    if now:
        yield now


def measure(texts: list[str | None], languages: Languages, profiles: Profiles) -> dict[str, list]:
    """The statistics of each text, as columns."""
    out: dict[str, list] = {f.name: [] for f in STATISTICS}
    for portion in _portions([t or "" for t in texts]):
        tokens = Tokens(portion, languages)
        parts = tokens.distributions()
        words, chars = tokens.words, tokens.chars.sum(axis=1)
        signs = chars - tokens.chars[:, [_LETTER, _DIGIT, _BLANK, _BREAK]].sum(axis=1)
        sentences = parts[1][:, _SENTENCES.ravel()].sum(axis=1)
        ratio = lambda a, b: [float(x / y) if y else None for x, y in zip(a, b)]
        out["n_words"] += words.tolist()
        out["mean_word_length"] += ratio(tokens.letters, words)
        out["symbol_ratio"] += ratio(signs, chars)
        out["ended_lines"] += ratio(tokens.ended, tokens.lines)
        out["common_words"] += ratio(tokens.known, words)
        out["sentence_words"] += ratio(sentences, parts[1].sum(axis=1))
        out["words_lang"] += [languages.names[i] if k else None for i, k in zip(tokens.language, tokens.known)]
        kinds, least = profiles.nearest(parts)
        blank = [not t.strip() for t in portion]
        out["profile"] += ["noise" if b else k for b, k in zip(blank, kinds)]
        out["divergence"] += [None if b or np.isnan(x) else float(x) for b, x in zip(blank, least)]
    return out


def text_statistics(docs: DataFrame, common: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, statistics) for every document: counts, shares, the nearest profile and its divergence.

    ``n_words`` words, whose parts hyphens and apostrophes join; ``symbol_ratio`` share of characters that are neither letters,
    digits nor blanks; ``ended_lines`` share of non-blank lines that end in punctuation; ``common_words`` share of words in the
    list of the language that most of them belong to, which is ``words_lang``; ``sentence_words`` share of words in sentences.

    Null and empty texts have 0 words, null ratios and the profile ``noise``. Null keys and repeated rows are kept as they
    are; texts are read as a whole; an empty table gives no rows; other columns are ignored. ``common`` must be a list of
    frequent words (lang, word_rank, word), a few hundred by language; an empty list leaves all words uncommon.
    """
    languages = Languages([tuple(r) for r in common.select("lang", "word_rank", "word").collect()])
    rows = docs.select(key, text)
    share = min(1.0, SAMPLE / max(rows.count(), 1))
    chosen = F.pmod(F.xxhash64(key, F.length(text)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = rows.where(chosen & F.col(text).isNotNull() & (F.length(text) <= LONGEST)).select(text).limit(2 * SAMPLE).toArrow()
    profiles = Profiles(sorted(sample.column(0).to_pylist()), languages)
    schema = T.StructType([rows.schema[key], *STATISTICS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = measure(batch.column(1).to_pylist(), languages, profiles)
            columns = [batch.column(0), *(pa.array(values[f.name], arrow.field(f.name).type) for f in STATISTICS)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)
