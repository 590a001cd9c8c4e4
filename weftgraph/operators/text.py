"""Text cleanup of papers as DataFrame operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

def per_text(df: DataFrame, keys: list[str], text: str, columns: str, rows) -> DataFrame:
    """(keys, columns) with the rows (dicts) that ``rows`` makes of each text; no shuffle. Null texts give none."""
    schema = T.StructType.fromDDL(columns)
    source = df.select(*keys, F.col(text).alias("__text")).where("__text IS NOT NULL")
    whole = T.StructType([*[source.schema[k] for k in keys], *schema.fields])
    arrow = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, values = [], []
            for i, value in enumerate(batch.columns[-1].to_pylist()):
                for row in rows(value):
                    owners.append(i)
                    values.append(row)
            at = pa.array(owners, pa.int64())
            made = [pa.array([v[f.name] for v in values], arrow.field(f.name).type) for f in schema]
            yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:-1]), *made], schema=arrow)

    return source.mapInArrow(run, whole)


def lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line_no, line): the lines of each text from 0."""
    return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def repeated_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line, n): lines that run through a text, as headers and footers do.

    At least four times, of fifteen characters or more with three letters in a row, without a bar, no bullet and no heading,
    and from first to last over more than half of the span of the text's lines. Counts are combined before the shuffle, so a
    line that a third of all rows hold is no hot group.
    """
    live = lines(df, keys, text).select(*keys, "line_no", F.trim("line").alias("line")).where("line <> ''")
    span = live.groupBy(*keys).agg((F.max("line_no") - F.min("line_no")).alias("span"))
    fits = (
        (F.char_length("line") >= 15)
        & F.col("line").rlike("[A-Za-z]{3}")
        & ~F.col("line").contains("|")
        & ~F.col("line").rlike(r"^[-*]")
        & ~F.col("line").rlike(r"^#{1,6}\s")
    )
    counted = live.where(fits).groupBy(*keys, "line").agg(
        F.count(F.lit(1)).alias("n"), (F.max("line_no") - F.min("line_no")).alias("reach")
    )
    return counted.where("n >= 4").join(span, keys).where("span > 0 AND reach > 0.5 * span").select(*keys, "line", "n")


def page_number_runs(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, n): texts with at least five page-number lines of which four fifths follow the one before by one."""
    page = r"(?i)^\s*(page\s+)?\d{1,3}(\s+of\s+\d+)?\s*$"
    found = lines(df, keys, text).where(F.col("line").rlike(page))
    found = found.select(*keys, "line_no", F.regexp_extract("line", r"\d+", 0).cast("int").alias("number"))
    before = F.lag("number").over(Window.partitionBy(*keys).orderBy("line_no"))
    steps = found.withColumn("step", F.when(F.col("number") == before + 1, 1).otherwise(0))
    counted = steps.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("step").alias("rising"))
    return counted.where("n >= 5 AND rising >= 0.8 * (n - 1)").select(*keys, "n")


def rejoined(text: Column) -> Column:
    """Words broken by a hyphen at a line's end, joined."""
    return F.regexp_replace(text, r"(?U)(\w)-\n(\w)", "$1$2")


def without_citation_links(text: Column) -> Column:
    """Citation links replaced by their text."""
    return F.regexp_replace(text, r"\[([^\]]*)\]\(#(bib\.bib\d+)\)", "$1")


def paper_id(text: Column) -> Column:
    """The first paper id that a reference names, or null."""
    pattern = r"(?i)(?:arxiv[:\s]*|arxiv\.org/(?:abs|pdf)/)(\d{4}\.\d{4,5})(v\d+)?"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def doi(text: Column) -> Column:
    """The first DOI in a text, or null."""
    return F.nullif(F.regexp_extract(text, r"\b(10\.\d{4,9}/[^\s\"<>]+[^\s\"<>.,;)])", 1), F.lit(""))


def citation_numbers(text: Column) -> Column:
    """Numbers of a citation such as ``1, 3-5`` in order; ranges of 50 or more are left out."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    low = lambda p: F.regexp_extract(p, r"^(\d+)", 1).cast("int")
    high = lambda p: F.regexp_extract(p, r"(\d+)$", 1).cast("int")
    ranged = r"^\d+\s*[–-]\s*\d+$"
    each = F.transform(
        parts,
        lambda p: F.when(p.rlike(ranged) & (high(p) - low(p) >= 0) & (high(p) - low(p) < 50), F.sequence(low(p), high(p)))
        .when(p.rlike(r"^\d+$"), F.array(low(p)))
        .otherwise(F.array().cast("array<int>")),
    )
    return F.flatten(F.filter(each, lambda x: x.isNotNull()))


def removal_flags(df: DataFrame, most: float = 0.5, least: float = 0.02) -> DataFrame:
    """``df`` with ``share``, the share of tokens outside appendices that was removed, and flags for unusual shares.

    Needs tokens_before, tokens_after and removed; a missing count leaves share and its flags null.
    """
    base = F.col("tokens_before") - F.coalesce(F.try_element_at("removed", F.lit("appendix_tokens")), F.lit(0))
    share = F.lit(1) - F.try_divide("tokens_after", base)
    return df.withColumn("share", share).withColumn("too_much", F.col("share") > most).withColumn("too_little", F.col("share") < least)
