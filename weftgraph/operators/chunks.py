"""Chunks of papers: paragraphs of one section together, up to a number of tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.strings import trimmed
from weftgraph.functions.tokens import pieces
from weftgraph.operators.cleaning import sections

#: Most tokens of a chunk.
TOKENS = 1200


def packed(sizes: Column, most: int) -> Column:
    """The number, from 0, of the group that each of an array of sizes is in, if groups are filled in order up to ``most``.

    A size above ``most`` is a group of its own.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).alias("group"), F.array().cast("array<int>").alias("groups"))

    def step(state: Column, size: Column) -> Column:
        fits = (state["group"] >= 0) & (state["sum"] + size <= most)
        group = F.when(fits, state["group"]).otherwise(state["group"] + 1)
        return F.struct(
            F.when(fits, state["sum"] + size).otherwise(size).alias("sum"), group.alias("group"), F.array_append(state["groups"], group).alias("groups")
        )

    return F.aggregate(F.transform(sizes, lambda n: n.cast("bigint")), start, step, lambda state: state["groups"])


def chunks(df: DataFrame, key: str, text: str, most: int = TOKENS, count: Callable[[Column], Column] = pieces) -> DataFrame:
    """(chunk_id, key, ord, tokens, heading, content) of each text.

    Paragraphs, which blank lines part, are put together in order within a section while they have at most ``most`` tokens; a
    longer paragraph is a chunk of its own. ``heading`` holds the section's title and those around it; ``ord`` counts a text's
    chunks from 0. Sections without text give none. Keys must be unique; null keys and texts are left out.
    """
    rows = df.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull())
    found = sections(rows, [key], text).select(key, "sec_no", "heading_level", "start_line", "end_line", "section_path")
    lines = F.split(text, "\n")
    first = F.col("start_line") + F.when(F.col("heading_level") > 0, 1).otherwise(0)
    body = F.array_join(F.slice(lines, first + 1, F.greatest(F.col("end_line") - first, F.lit(0))), "\n")
    parts = F.filter(F.transform(F.split(body, r"\n\s*\n"), trimmed), lambda p: p != "")
    sized = found.join(rows, key).select(key, "sec_no", "section_path", parts.alias("parts"))
    numbered = sized.withColumn("groups", packed(F.transform("parts", count), most))
    each = numbered.select(key, "sec_no", "section_path", F.posexplode(F.arrays_zip("groups", "parts")).alias("nth", "part"))
    gathered = each.groupBy(key, "sec_no", F.col("part.groups").alias("group")).agg(
        F.first("section_path").alias("path"), F.array_sort(F.collect_list(F.struct("nth", F.col("part.parts").alias("text")))).alias("texts")
    )
    content = F.array_join(F.transform("texts", lambda x: x["text"]), "\n\n")
    heading = F.struct(
        F.try_element_at("path", F.lit(-1)).alias("heading"), F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))).alias("parent_headings")
    )
    order = F.array_sort(F.collect_list(F.struct("sec_no", "group", heading.alias("heading"), content.alias("content"))))  # a text's chunks
    listed = gathered.groupBy(key).agg(order.alias("all")).select(key, F.posexplode("all").alias("ord", "c"))
    return listed.select(
        F.concat(F.lit("chunk-"), F.md5(F.concat_ws("|", F.col(key).cast("string"), "ord", "c.content"))).alias("chunk_id"),
        key,
        "ord",
        count(F.col("c.content")).alias("tokens"),
        "c.heading",
        "c.content",
    )
