"""Cleaning Markdown papers: sections, references, citations, and what is not worth keeping, as windows over lines.

A text becomes rows of lines that stay in one partition: every window is over a text, in the order of its lines, so a text is
shuffled once. What holds for a section (its subtree, whether it goes) is carried from its heading to its lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weftgraph.functions.strings import trimmed
from weftgraph.functions.tokens import pieces
from weftgraph.operators.text import citation_numbers, doi, paper_id, rejoined, without_citation_links

# Patterns of headings, references, citations and running lines, equal to the semantics they reproduce.
HEADING = r"(?U)^(#{1,6})\s+(.*?)\s*#*\s*$"
REFERENCES = r"(?i)^(\d+(\.\d+)*\.?\s+)?(references|bibliography|literature cited|works cited)\b"
DROPPED = (
    r"(?i)^(\d+(\.\d+)*\.?\s+)?(acknowledge?ments?|funding|financial (support|disclosure)|author(s'?)? contributions?|"
    r"contributions? statement|credit authorship.*)\b"
)
APPENDIX = r"(?i)^(appendix|appendices|supplementary)"
APPENDIX_START = r"(?i)^(appendix|appendices)"
APPENDIX_LETTER = r"^[A-Z](\.\d+)*\.?\s+\S"
KEYED_ENTRY = r"^\s*[-*]\s+\[(bib\.bib\d+)\]\s*(.*)$"
NUMBERED_ENTRY = r"^\s*(?:[-*]\s+)?\[(\d+)\]\s+(.*)$"
BULLET_ENTRY = r"^\s*[-*]\s+(\S.*)$"
CITATION_LINK = r"\[([^\]]*)\]\(#(bib\.bib\d+)\)"
CITATION_NUMBERS = r"\[(\d+(?:\s*[,–-]\s*\d+)*)\]"
PAGE_NUMBER = r"(?i)^\s*(page\s+)?\d{1,3}(\s+of\s+\d+)?\s*$"
STAMP = r"^\s*arXiv:\d{4}\.\d{4,5}v\d+\s+\[[^\]]+\]\s+\d{1,2}\s+\w+\s+\d{4}\s*$"
ABBREVIATIONS = r"(?i:\b(?:et al|e\.g|i\.e|cf|Figs?|Eqs?|Sec|Tab|vs|resp|approx)\.)"

#: Citing sentences kept for an entry, and their length.
CITING, CITING_LENGTH = 10, 600

_OPENS = r"(?=[A-Z\[(])(?![^\[\]]{0,2000}+\]\(#bib\.bib\d+\))"
_GAP = rf"(?U)(?<={ABBREVIATIONS})\s+{_OPENS}"
_END = rf"(?U)(?<=[.!?])(?<!{ABBREVIATIONS})\s+{_OPENS}"


def split_sentences(text: Column) -> Column:
    """The sentences of a text; abbreviations and the text of citation links don't end one."""
    return F.split(F.regexp_replace(text, _GAP, " "), _END)


def sentences(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, sentence_no, sentence) of each text, numbered from 0. Null texts give no rows, an empty text one."""
    rows = df.where(F.col(text).isNotNull())
    return rows.select(*keys, F.posexplode(split_sentences(F.col(text))).alias("sentence_no", "sentence"))


def _text() -> WindowSpec:
    """All lines of a text."""
    return Window.partitionBy("k")


def _rows(low: int, high: int) -> WindowSpec:
    return _text().orderBy("line_no").rowsBetween(low, high)


def _before() -> WindowSpec:
    return _rows(Window.unboundedPreceding, -1)


def _so_far() -> WindowSpec:
    return _rows(Window.unboundedPreceding, 0)


def _after() -> WindowSpec:
    return _rows(1, Window.unboundedFollowing)


def _lines(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """(k, line_no, line, sec_no, heading): lines of each different text, and for headings (level, title).

    ``k`` holds the keys and a hash of the text, so texts under the same keys stay apart and repeated rows count once.
    """
    rows = df.select(F.struct(*keys, F.xxhash64(text).alias("text_hash")).alias("k"), text.alias("text")).where("text IS NOT NULL")
    lines = rows.dropDuplicates(["k"]).select("k", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    fences = F.sum(F.when(F.ltrim("line").startswith("```"), 1).otherwise(0)).over(_so_far())
    found = (fences % 2 == 0) & F.col("line").rlike(HEADING)
    level = F.char_length(F.regexp_extract("line", HEADING, 1))
    heading = F.when(found, F.struct(level.alias("level"), trimmed(F.regexp_extract("line", HEADING, 2)).alias("title"), F.col("line_no").alias("start")))
    return lines.withColumn("heading", heading).withColumn("sec_no", F.count("heading").over(_so_far()).cast("int"))


def _subtree_end(lines: DataFrame) -> DataFrame:
    """``lines`` with ``whole`` at headings: the line of the next heading that isn't below it, or the number of lines."""
    ends = [
        F.min(F.when(F.col("heading.level") <= level, F.col("line_no"))).over(_after()).alias(f"end_{level}") for level in range(1, 7)
    ]
    rows = lines.select("*", *ends, (F.max("line_no").over(_text()) + 1).alias("total"))
    own = F.element_at(F.array(*[F.col(f"end_{level}") for level in range(1, 7)]), F.col("heading.level"))
    return rows.withColumn("whole", F.when(F.col("heading").isNotNull(), F.coalesce(own, "total"))).drop(*[f"end_{n}" for n in range(1, 7)])


def _path(lines: DataFrame) -> DataFrame:
    """``lines`` with ``path`` at headings: the titles of the sections around it and its own.

    A section of some level is still open if it is the last one of that level or a higher one.
    """
    last = [
        F.last(F.when(F.col("heading.level") <= level, F.col("heading")), ignorenulls=True).over(_before()).alias(f"last_{level}")
        for level in range(1, 6)
    ]
    above = [
        F.when((F.col(f"last_{n}.level") == n) & (F.col("heading.level") > n), F.col(f"last_{n}.title")) for n in range(1, 6)
    ]
    path = F.array_append(F.array_compact(F.array(*above)), F.col("heading.title"))
    rows = lines.select("*", *last).withColumn("path", F.when(F.col("heading").isNotNull(), path))
    return rows.drop(*[f"last_{n}" for n in range(1, 6)])


def sections(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, sec_no, heading_level, title, start_line, end_line, subtree_end, section_path) of each text.

    Headings in fenced code are text. Section 0 is what stands before the first heading; it has no title, and is left out if
    it has no lines. Null texts give no rows; an empty table gives none.
    """
    lines = _path(_subtree_end(_lines(df, keys, F.col(text))))
    found = lines.groupBy("k", "sec_no").agg(
        F.min("line_no").alias("start_line"),
        (F.max("line_no") + 1).alias("end_line"),
        *[F.max(c).alias(c) for c in ("heading", "whole", "path")],
    )
    return found.select(
        "k.*",
        "sec_no",
        F.coalesce("heading.level", F.lit(0)).alias("heading_level"),
        F.col("heading.title").alias("title"),
        "start_line",
        "end_line",
        F.coalesce("whole", "end_line").alias("subtree_end"),
        F.coalesce("path", F.array().cast("array<string>")).alias("section_path"),
    ).drop("text_hash")


def _marked(df: DataFrame, keys: list[str], text: str, drop_appendix: bool) -> DataFrame:
    """All lines of the texts with what becomes of them: list (start of the reference list), cut (in an appendix), gone."""
    lines = _path(_subtree_end(_lines(df, keys, rejoined(F.col(text)))))
    title, level, start, whole = F.col("heading.title"), F.col("heading.level"), F.col("line_no"), F.col("whole")
    within = lambda flag, window: F.coalesce(F.max(F.when(flag, whole)).over(window) > start, F.lit(False))
    lines = lines.withColumns({"is_list": F.coalesce(title.rlike(REFERENCES), F.lit(False)), "is_thanks": F.coalesce(title.rlike(DROPPED), F.lit(False))})
    lines = lines.withColumns(
        {
            "first_list": F.min(F.when(F.col("is_list"), F.struct("line_no", level.alias("level")))).over(_text()),
            "dropped": within(F.col("is_list") | F.col("is_thanks"), _so_far()),
            "new_list": F.col("is_list") & ~within(F.col("is_list"), _before()),
            "in_list": within(F.col("is_list"), _so_far()),
            "top": F.min(F.when(level > 1, level)).over(_text()),
        }
    )
    top = F.coalesce("first_list.level", "top", F.lit(2))
    lines = lines.withColumn("candidate", F.coalesce((level <= top) & ~F.col("dropped"), F.lit(False)))
    lettered = F.coalesce(F.max(F.col("candidate") & title.rlike(APPENDIX_START)).over(_before()), F.lit(False))
    after = F.coalesce(start > F.col("first_list.line_no"), F.lit(False))
    appendix = F.lit(drop_appendix) & F.col("candidate") & (after | title.rlike(APPENDIX) | (lettered & title.rlike(APPENDIX_LETTER)))
    lines = lines.withColumn("appendix", F.coalesce(appendix, F.lit(False)))
    lines = lines.withColumns({"new_appendix": F.col("appendix") & ~within(F.col("appendix"), _before()), "in_appendix": within(F.col("appendix"), _so_far())})
    return lines.withColumns(
        {
            "list": F.when(F.col("in_list"), F.last(F.when(F.col("new_list"), start), ignorenulls=True).over(_so_far())),
            "cut": F.col("in_appendix") & ~F.col("dropped"),
            "gone": F.col("in_appendix") | F.col("dropped"),
            "bare": trimmed("line"),
        }
    )


def _without_running_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``running``: headers that run through a text, page numbers in an ascending run, and stamps."""
    live = ~F.col("gone") & (F.col("bare") != "")
    page = live & F.col("line").rlike(PAGE_NUMBER)
    at = F.when(live, F.col("line_no"))
    same = Window.partitionBy("k", "bare")
    number = F.when(page, F.regexp_extract("line", r"\d+", 0).cast("int"))
    lines = lines.withColumns({"live": live, "number": number}).withColumns(
        {
            "follows": (F.col("number") == F.last("number", ignorenulls=True).over(_before()) + 1).cast("int"),
            "span": F.max(at).over(_text()) - F.min(at).over(_text()),
            "times": F.count(at).over(same),
            "reach": F.max(at).over(same) - F.min(at).over(same),
        }
    )
    pages, rising = F.count("number").over(_text()), F.coalesce(F.sum("follows").over(_text()), F.lit(0))
    bare = F.col("bare")
    header = (
        (F.col("times") >= 4)
        & (F.char_length(bare) >= 15)
        & bare.rlike("[A-Za-z]{3}")
        & ~bare.contains("|")
        & ~bare.rlike("^[-*]")
        & (F.col("span") > 0)
        & (F.col("reach") > 0.5 * F.col("span"))
    )
    numbered = F.col("number").isNotNull() & (pages >= 5) & (rising >= 0.8 * (pages - 1))
    return lines.withColumn("running", F.col("live") & ~bare.rlike(HEADING) & (header | numbered | F.col("line").rlike(STAMP)))


def _in_order(line: str, when: Column, glue: str) -> Column:
    """The lines of a group for which ``when`` holds, in order and joined."""
    kept = F.array_sort(F.collect_list(F.when(when, F.struct("line_no", line))))
    return F.array_join(F.transform(kept, lambda x: x[line]), glue)


def _entries(lines: DataFrame) -> DataFrame:
    """(k, entry_no, key, raw): the entries of the texts' reference lists, from 1.

    A keyed, numbered or bulleted line begins an entry, and so does any other after a blank line, which closes the entry before
    unless the list is keyed. Other lines continue an entry, headings are passed over.
    """
    at = Window.partitionBy("k", "list").orderBy("line_no")
    before, so_far = (at.rowsBetween(Window.unboundedPreceding, n) for n in (-1, 0))
    line = F.col("line")
    kind = F.when(line.rlike(KEYED_ENTRY), "keyed").when(line.rlike(NUMBERED_ENTRY), "numbered").when(line.rlike(BULLET_ENTRY), "bullet")
    rows = lines.where("list IS NOT NULL AND line_no > list").withColumn("kind", kind.when(F.col("bare") == "", "blank").otherwise("text"))
    rows = rows.where((F.col("kind") != "text") | ~line.rlike(HEADING))
    last = lambda c: F.last(c, ignorenulls=True).over(before)
    marked = F.col("kind").isin("keyed", "numbered", "bullet")
    closed = F.coalesce(last("kind"), F.lit("blank")) == "blank"
    keyed = F.coalesce(last(F.when(marked, F.col("kind"))) == "keyed", F.lit(False))
    rows = rows.withColumn("begins", marked | ((F.col("kind") == "text") & closed & ~keyed)).where("kind <> 'blank'")
    rows = rows.withColumn("nth", F.sum(F.col("begins").cast("int")).over(so_far))
    own = (
        F.when(F.col("kind") == "keyed", F.struct(F.regexp_extract(line, KEYED_ENTRY, 1).alias("key"), F.regexp_extract(line, KEYED_ENTRY, 2).alias("piece")))
        .when(F.col("kind") == "numbered", F.struct(F.regexp_extract(line, NUMBERED_ENTRY, 1).alias("key"), F.regexp_extract(line, NUMBERED_ENTRY, 2).alias("piece")))
        .when(F.col("kind") == "bullet", F.struct(F.col("nth").cast("string").alias("key"), F.regexp_extract(line, BULLET_ENTRY, 1).alias("piece")))
        .otherwise(F.struct(F.col("nth").cast("string").alias("key"), line.alias("piece")))
    )
    rows = rows.select("k", "list", "nth", "line_no", own.alias("own")).select("k", "list", "nth", "line_no", "own.key", trimmed("own.piece").alias("piece"))
    found = rows.groupBy("k", "list", "nth").agg(F.min_by("key", "line_no").alias("key"), _in_order("piece", F.lit(True), " ").alias("raw"))
    number = F.row_number().over(Window.partitionBy("k").orderBy("list", "nth"))
    return found.select("k", number.alias("entry_no"), "key", "raw")


def _citing(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """(k, entry_no, citing): the first sentences that cite each entry, with the titles of their sections.

    Of entries with the same key the last one is cited. Numbers in brackets cite only where the first entry isn't keyed.
    """
    listed = entries.groupBy("k", "key").agg(F.max("entry_no").alias("entry_no"))
    first = entries.where("entry_no = 1").select("k", (~F.col("key").startswith("bib.")).alias("numbered"))
    body = lines.where(~F.col("gone") & (F.col("sec_no") > 0)).groupBy("k", "sec_no").agg(
        _in_order("line", (F.col("bare") != "") & F.col("heading").isNull(), " ").alias("body"), F.max("path").alias("path")
    )
    told = body.join(first, "k").select("k", "sec_no", "path", "numbered", F.posexplode(split_sentences(F.col("body"))).alias("nth", "sentence"))
    links = F.regexp_extract_all("sentence", F.lit(CITATION_LINK), F.lit(2))
    listed_numbers = F.transform(F.regexp_extract_all("sentence", F.lit(CITATION_NUMBERS), F.lit(1)), citation_numbers)
    numbers = F.transform(F.flatten(listed_numbers), lambda n: n.cast("string"))
    cited = F.when((F.size(links) == 0) & F.col("numbered"), numbers).otherwise(links)
    told = told.select("k", "sec_no", "path", "nth", "sentence", F.explode(F.array_distinct(cited)).alias("key"))
    place = F.row_number().over(Window.partitionBy("k", "entry_no").orderBy("sec_no", "nth"))
    told = told.join(listed, ["k", "key"]).withColumn("place", place).where(F.col("place") <= CITING)
    plain = F.substring(trimmed(without_citation_links(F.col("sentence"))), 1, CITING_LENGTH)
    citing = F.struct("place", F.struct(plain.alias("sentence"), F.array_join("path", " > ").alias("section")).alias("told"))
    ordered = F.transform(F.array_sort(F.collect_list(citing)), lambda x: x["told"])  # ten at most
    return told.groupBy("k", "entry_no").agg(ordered.alias("citing"))


def references(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, entry_no, key, raw, arxiv_id, doi, citing) of all references of each text."""
    return _references(_marked(df, keys, text, True)).select("k.*", "entry_no", "reference.*").drop("text_hash")


def _references(lines: DataFrame) -> DataFrame:
    entries = _entries(lines)
    found = entries.join(_citing(lines, entries), ["k", "entry_no"], "left")
    none = F.array().cast("array<struct<sentence:string,section:string>>")
    raw = F.col("raw")
    reference = F.struct("key", "raw", paper_id(raw).alias("arxiv_id"), doi(raw).alias("doi"), F.coalesce("citing", none).alias("citing"))
    return found.select("k", "entry_no", reference.alias("reference"))


def cleaned(
    df: DataFrame,
    keys: list[str],
    text: str,
    drop_appendix: bool = True,
    most: float = 0.5,
    least: float = 0.02,
    count: Callable[[Column], Column] = pieces,
) -> DataFrame:
    """(keys, text, references, tokens_before, tokens_after, removed, flags) of each Markdown text.

    References, acknowledgements, appendices and running lines go; citation links become plain text; words broken at a line's
    end are joined. ``removed`` counts lines by reason and the appendices' tokens. Flags tell if more than ``most`` or less
    than ``least`` of the tokens outside appendices went, or no reference was found. ``count`` maps a text to its tokens; lines
    are counted one by one, so no token may reach over a line's end. Null texts give no rows; different texts under the same
    keys give a row each, repeated rows one.
    """
    lines = _without_running_lines(_marked(df, keys, text, drop_appendix))
    size = F.col("whole") - F.col("line_no")
    summed = lambda flag, value: F.coalesce(F.sum(F.when(flag, value)), F.lit(0)).cast("bigint")
    tokens = count(F.col("line"))
    kept = ~F.col("gone") & ~F.col("running")
    found = lines.groupBy("k").agg(
        _in_order("line", kept, "\n").alias("text"),
        summed(F.lit(True), tokens).alias("tokens_before"),
        summed(F.col("cut"), tokens).alias("appendix_tokens"),
        summed(F.col("is_list"), size).alias("references"),
        summed(F.col("is_thanks"), size).alias("acknowledgements"),
        summed(F.col("new_appendix"), size).alias("appendix"),
        summed(F.col("running"), F.lit(1)).alias("repeated_lines"),
    )
    plain = F.concat(trimmed(F.regexp_replace(without_citation_links(F.col("text")), r"\n{3,}", "\n\n")), F.lit("\n"))
    reasons = ("references", "acknowledgements", "appendix", "repeated_lines")
    removed = F.map_filter(F.create_map(*[x for r in reasons for x in (F.lit(r), F.col(r))]), lambda _, n: n > 0)
    removed = F.map_concat(removed, F.create_map(F.lit("appendix_tokens"), "appendix_tokens"))
    found = found.select("k", plain.alias("text"), "tokens_before", "appendix_tokens", removed.alias("removed"))
    found = found.withColumn("tokens_after", count(F.col("text")).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct("entry_no", "reference")))
    listed = _references(lines).groupBy("k").agg(F.transform(ordered, lambda x: x["reference"]).alias("references"))
    found = found.join(listed, "k", "left")
    base = F.col("tokens_before") - F.col("appendix_tokens")
    share = F.when(base == 0, 0.0).otherwise(1 - F.col("tokens_after") / base)
    limits = [f"{x:.0%}".replace("%", "%%") for x in (most, least)]
    flags = F.array_compact(
        F.array(
            F.when(share > most, F.format_string("removed %.0f%% of tokens (> " + limits[0] + ")", share * 100)),
            F.when(share < least, F.format_string("removed %.1f%% of tokens (< " + limits[1] + ")", share * 100)),
            F.when(F.col("references").isNull(), F.lit("no reference entries found")),
        )
    )
    none = F.array().cast(listed.schema["references"].dataType)
    return found.select(
        "k.*", "text", F.coalesce("references", none).alias("references"), "tokens_before", "tokens_after", "removed", flags.alias("flags")
    ).drop("text_hash")
