"""Queries on sections of cleaned papers that are cut into pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.functions.strings import trimmed
from weftgraph.llm.splitting import split_oversized
from weftgraph.sources.tables import table


def section_bodies(papers: DataFrame, sections: DataFrame) -> DataFrame:
    """(arxiv_id, sec_no, title, body): the lines of each section without its heading, trimmed.

    Of several texts of a paper the latest by cleaned_at counts (ties: the greater text), of several rows of a section the
    greatest. Sections of missing or null texts, or without line numbers, are left out.
    """
    last = F.row_number().over(Window.partitionBy("arxiv_id").orderBy(F.desc("cleaned_at"), F.desc("text")))
    texts = papers.where("arxiv_id IS NOT NULL AND text IS NOT NULL").withColumn("nth", last).where("nth = 1")
    spans = sections.groupBy("arxiv_id", "sec_no").agg(
        F.max(F.struct("start_line", "end_line", "heading_level", "title")).alias("s")
    )
    skip = F.when(F.coalesce("s.heading_level", F.lit(0)) > 0, 1).otherwise(0)
    first = F.greatest(F.col("s.start_line"), F.lit(0)) + skip
    lines = F.slice(F.split("text", "\n"), first + 1, F.greatest(F.col("s.end_line") - first, F.lit(0)))
    return (
        texts.select("arxiv_id", "text")
        .join(spans, "arxiv_id")
        .where("s.start_line IS NOT NULL AND s.end_line IS NOT NULL")
        .select("arxiv_id", "sec_no", F.col("s.title").alias("title"), trimmed(F.array_join(lines, "\n")).alias("body"))
    )


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All pieces of all sections: at most 1,500 characters, 150 of overlap, with their section's title."""
    bodies = section_bodies(
        table(spark, folder, "clean_results", "arxiv_id", "text", "cleaned_at"),
        table(spark, folder, "sections", "arxiv_id", "sec_no", "heading_level", "title", "start_line", "end_line"),
    )
    return split_oversized(bodies, ["arxiv_id", "sec_no", "title"], "body")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sections that had to be cut: those with a second piece."""
    return p3_pieces(spark, folder).where("piece_no = 1").select("arxiv_id", "sec_no")


QUERIES = {"p3_found": p3_found, "p3_pieces": p3_pieces}

_SPACE = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_ENDED = r"""[.!?…。！？]["'')\]}}»”’]?"""


def _stop(pos: str, room: int) -> str:
    """Where a piece whose new text begins at ``pos`` ends: the farthest paragraph, line, sentence or word end, in this order."""
    near = f"substring(body, {pos} + 1, {room} + 1)"
    strong = (rf"\n{_SPACE}*\n{_SPACE}*", rf"\n{_SPACE}*", rf"(?:{_ENDED.replace('}}', '}')}{_SPACE}+|\n{_SPACE}*)", rf"{_SPACE}+")
    cases = ""
    for pattern, share in zip(strong, (2, 2, 2, 4)):
        found = f"length(regexp_extract({near}, '^((?s:.*){pattern})[^{_SPACE[1:]}', 1))"
        cases += f" WHEN {found} >= {max(room // share, 1)} THEN {pos} + {found}"
    # without these, the farthest of the places that part a long stretch without blanks into 168 characters each
    word = f"length(regexp_extract({near}, '^((?s:.*){strong[3]})[^{_SPACE[1:]}', 1))"
    anywhere = f"{pos} + {word} + (({room} - {word}) // 168) * 168"
    return f"CASE WHEN {pos} + {room} >= length(body) THEN length(body){cases} ELSE {anywhere} END"


ORACLES = {
    "p3_found": r"""
        WITH texts AS (SELECT DISTINCT arxiv_id, text FROM clean_results),
        spans AS (SELECT DISTINCT arxiv_id, sec_no, heading_level, start_line, end_line FROM sections),
        bodies AS (
          SELECT arxiv_id, sec_no, trim(array_to_string(list_slice(string_split(text, chr(10)),
            start_line + 1 + CAST(heading_level > 0 AS INT), end_line), chr(10)), ' ' || chr(9) || chr(10) || chr(13)) AS body
          FROM texts JOIN spans USING (arxiv_id)
        )
        SELECT arxiv_id, sec_no FROM bodies WHERE length(body) > 1500""",
    "p3_pieces": rf"""
        WITH RECURSIVE texts AS (SELECT DISTINCT arxiv_id, text FROM clean_results),
        spans AS (SELECT DISTINCT arxiv_id, sec_no, heading_level, start_line, end_line, title FROM sections),
        bodies AS (
          SELECT arxiv_id, sec_no, title, trim(array_to_string(list_slice(string_split(text, chr(10)),
            start_line + 1 + CAST(heading_level > 0 AS INT), end_line), chr(10)), ' ' || chr(9) || chr(10) || chr(13)) AS body
          FROM texts JOIN spans USING (arxiv_id)
        ), cuts(arxiv_id, sec_no, title, body, piece_no, pos, stop) AS (
          SELECT arxiv_id, sec_no, title, body, 0, 0, {_stop('0', 1500)} FROM bodies WHERE body <> ''
          UNION ALL
          SELECT arxiv_id, sec_no, title, body, piece_no + 1, stop, {_stop('stop', 1350)} FROM cuts WHERE stop < length(body)
        )
        SELECT arxiv_id, sec_no, title, CAST(piece_no AS INT) AS piece_no, CAST(CASE WHEN piece_no > 0 THEN pos - 150 ELSE 0 END AS INT) AS piece_start,
          CAST(stop AS INT) AS piece_end, substring(body, CASE WHEN piece_no > 0 THEN pos - 149 ELSE 1 END, stop - CASE WHEN piece_no > 0 THEN pos - 150 ELSE 0 END) AS piece
        FROM cuts""",
}
