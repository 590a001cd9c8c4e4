"""Queries on texts, pages and intake, over whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators import intake, text
from weftgraph.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    """Register a query under its name, with its SQL if it has one."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL")
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    """sha-256 of every document's text."""
    rows = table(spark, folder, "documents", "doc_id", "text").where("text IS NOT NULL")
    return rows.select("doc_id", intake.content_hash(F.col("text")).alias("content_hash"))


@query(
    """WITH scan AS (
      SELECT arxiv_id, arg_max(lower(trim(content_hash)), scanned_at) AS content_hash FROM corpus_scan
      WHERE arxiv_id IS NOT NULL AND trim(content_hash) <> '' GROUP BY arxiv_id
    ), seen AS (
      SELECT arxiv_id, lower(trim(content_hash)) AS known, lower(trim(status)) AS last,
        row_number() OVER (PARTITION BY arxiv_id ORDER BY recorded_at DESC NULLS LAST, loaded_at DESC NULLS LAST, run_no DESC NULLS LAST) AS rn
      FROM manifest WHERE arxiv_id IS NOT NULL
    )
    SELECT s.arxiv_id, s.content_hash, m.known AS previous_hash, CASE WHEN m.arxiv_id IS NULL THEN 'new' ELSE 'changed' END AS status
    FROM scan AS s LEFT JOIN (SELECT * FROM seen WHERE rn = 1) AS m USING (arxiv_id)
    WHERE NOT coalesce(m.known = s.content_hash AND m.last = 'indexed', false)"""
)
def change_detection(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest records of papers to process, with their hashes before and now."""
    papers = intake.latest_scan(table(spark, folder, "corpus_scan"))
    known = intake.latest_state(table(spark, folder, "manifest", "arxiv_id", "run_no", "content_hash", "status", "recorded_at", "loaded_at"))
    known = known.withColumnRenamed("known_hash", "content_hash")
    return intake.intake(papers, known, papers.select("arxiv_id")).select("arxiv_id", "content_hash", "previous_hash", "status")


LINES_SQL = """
  numbered AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM documents WHERE text IS NOT NULL
  ), live AS (SELECT doc_id, line_no, trim(line) AS line FROM numbered WHERE trim(line) <> '')"""


@query(
    f"""WITH {LINES_SQL}, spans AS (SELECT doc_id, max(line_no) - min(line_no) AS span FROM live GROUP BY doc_id),
    counted AS (
      SELECT doc_id, line, count(*) AS n, max(line_no) - min(line_no) AS reach FROM live
      WHERE length(line) >= 15 AND regexp_matches(line, '[A-Za-z]{{3}}') AND NOT contains(line, '|')
        AND NOT regexp_matches(line, '^[-*]') AND NOT regexp_matches(line, '^#{{1,6}}\\s')
      GROUP BY doc_id, line HAVING count(*) >= 4
    ) SELECT doc_id, line, CAST(n AS BIGINT) AS n FROM counted JOIN spans USING (doc_id) WHERE span > 0 AND reach > 0.5 * span"""
)
def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that run through a document."""
    return text.repeated_lines(table(spark, folder, "documents", "doc_id", "text"), ["doc_id"], "text")


@query(
    f"""WITH {LINES_SQL} SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(max(length(line)) AS BIGINT) AS longest,
      CAST(count(DISTINCT line) AS BIGINT) AS different FROM live GROUP BY doc_id"""
)
def line_explode_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Non-blank lines of every document: number, longest, different ones."""
    rows = text.lines(table(spark, folder, "documents", "doc_id", "text"), ["doc_id"], "text")
    live = rows.select("doc_id", F.trim("line").alias("line")).where("line <> ''")
    return live.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max(F.char_length("line")).cast("bigint").alias("longest"), F.countDistinct("line").alias("different")
    )


@query(
    """SELECT arxiv_id, tokens_before, tokens_after,
      round(1 - tokens_after / nullif(tokens_before - coalesce(removed['appendix'], 0), 0), 4) AS share
    FROM (SELECT DISTINCT arxiv_id, tokens_before, tokens_after, removed FROM clean_results)"""
)
def removal_share(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the tokens outside appendices that cleaning removed."""
    rows = table(spark, folder, "clean_results", "arxiv_id", "tokens_before", "tokens_after", "removed")
    appendix = F.coalesce(F.try_element_at("removed", F.lit("appendix")), F.lit(0))
    rows = rows.select("arxiv_id", "tokens_before", "tokens_after", appendix.alias("appendix")).distinct()
    rows = rows.withColumn("removed", F.create_map(F.lit("appendix_tokens"), "appendix"))
    return text.removal_flags(rows).select("arxiv_id", "tokens_before", "tokens_after", F.round("share", 4).alias("share"))


#: References of several kinds, whose ids and numbers are extracted.
REFERENCES = [
    (1, "Doe. arXiv:2401.12345v2, 2024.", "1, 3-5"),
    (2, "Roe. https://arxiv.org/abs/2402.0001 doi 10.1234/ab.cd(5).", "7"),
    (3, "No id here.", "2-60, 4"),
    (4, "Poe. 10.5555/xyz-1, p. 3", "x, 9 – 11"),
]
_VALUES = ", ".join("({}, '{}', '{}')".format(*r) for r in REFERENCES)


#: Pages with what a page has that is no text.
PAGES = [
    (1, '<html><head><title>First &amp; last</title></head><body><nav>menu</nav><p>Body <a href="x">link</a> text</p></body></html>'),
    (2, "<html><head><title>Second</title></head><body><header>top</header><p>Only <b>bold</b></p><footer>end</footer></body></html>"),
]
_PAGES = ", ".join("({}, '{}')".format(*p) for p in PAGES)


@query(
    """SELECT doc_id, regexp_replace(text, '\\[([^\\]]*)\\]\\(#(bib\\.bib[0-9]+)\\)', '\\1', 'g') AS plain FROM documents WHERE contains(text, '[')"""
)
def link_removal(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with brackets, without citation links."""
    rows = table(spark, folder, "documents", "doc_id", "text").where(F.contains("text", F.lit("[")))
    return rows.select("doc_id", text.without_citation_links(F.col("text")).alias("plain"))


@query(
    """WITH known AS (SELECT DISTINCT arxiv_id FROM manifest WHERE arxiv_id IS NOT NULL)
    SELECT d.doc_id, d.arxiv_id, k.arxiv_id IS NOT NULL AS in_corpus FROM documents AS d LEFT JOIN known AS k USING (arxiv_id)"""
)
def in_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the paper of each document is in the manifest."""
    rows = table(spark, folder, "documents", "doc_id", "arxiv_id")
    return intake.in_corpus(rows, table(spark, folder, "manifest", "arxiv_id")).select("doc_id", "arxiv_id", "in_corpus")
