"""Measurements of a run: extraction, gleaning, parameters, types, calls, gates, bands, batches and review sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of extraction answers, and how a gleaning prompt begins.
ENTITY_ROW = r"(?m)^\s*\(?\s*entity<\|#\|>([^<\n]+)<\|#\|>"
RELATION_ROW = r"(?m)^\s*\(?\s*relation<\|#\|>"
GLEANING = "Based on the last extraction task"


def extraction_rows(cache: DataFrame) -> DataFrame:
    """(chunk_id, kind, names, relations) of answers (chunk_id, cache_type, prompt, answer) of extraction calls."""
    text = F.coalesce("answer", F.lit(""))
    kind = F.when(F.contains(F.substring(F.coalesce("prompt", F.lit("")), 1, 400), F.lit(GLEANING)), "glean").otherwise("extract")
    return cache.where("cache_type = 'extract'").select(
        "chunk_id",
        kind.alias("kind"),
        F.transform(F.regexp_extract_all(text, F.lit(ENTITY_ROW), F.lit(1)), lambda n: F.trim(n)).alias("names"),
        F.regexp_count(text, F.lit(RELATION_ROW)).alias("relations"),
    )


def gleaning_effect(rows: DataFrame) -> DataFrame:
    """One row: distinct names by extraction, new ones by gleaning, relation rows of both, and the rates."""
    names = rows.select("chunk_id", "kind", F.explode("names").alias("n")).select("chunk_id", "kind", F.lower("n").alias("n"))
    seen = names.groupBy("chunk_id", "n").agg(F.max((F.col("kind") == "extract").cast("int")).alias("extracted"))
    entities = seen.agg(F.count_if(F.col("extracted") == 1).alias("extract_names"), F.count_if(F.col("extracted") == 0).alias("glean_new_names"))
    relations = rows.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "extract", F.col("relations"))), F.lit(0)).alias("extract_relations"),
        F.coalesce(F.sum(F.when(F.col("kind") == "glean", F.col("relations"))), F.lit(0)).alias("glean_relations"),
    )
    return entities.crossJoin(relations).select(
        "*",
        F.round(F.try_divide("glean_new_names", "extract_names"), 3).alias("name_rate"),
        F.round(F.try_divide("glean_relations", "extract_relations"), 3).alias("relation_rate"),
    )


def ratio(a: Column | str, b: Column | str, digits: int) -> Column:
    """a / b rounded, null where b is 0."""
    return F.round(F.try_divide(a, b), digits)


def batch_parameters(batch: DataFrame) -> DataFrame:
    """Derived parameters of a row of counts of a batch (papers, chunks, entity_rows, relation_rows, names, new_names,
    names_in_clusters, focus, clusters, second_looks, embedded, merged, summaries)."""
    return batch.select(
        ratio("chunks", "papers", 2).alias("c"),
        ratio("entity_rows", "chunks", 2).alias("e"),
        ratio("relation_rows", "chunks", 2).alias("r"),
        ratio("new_names", "entity_rows", 3).alias("u"),
        F.round(1 - F.try_divide("new_names", "names"), 3).alias("known_share"),
        ratio("names_in_clusters", "focus", 3).alias("p"),
        ratio("names_in_clusters", "clusters", 2).alias("k"),
        ratio("second_looks", "clusters", 3).alias("q"),
        ratio("embedded", "merged", 2).alias("m"),
        ratio("summaries", "papers", 2).alias("summaries_per_paper"),
        ratio(F.col("summaries") * 7, F.col("entity_rows") + F.col("relation_rows"), 3).alias("h"),
    )


def type_distribution(nodes: DataFrame) -> DataFrame:
    """(type, n): nodes of each lower-case type, ``other`` if missing."""
    kind = F.coalesce(F.nullif(F.lower(F.trim("type")), F.lit("")), F.lit("other"))
    return nodes.groupBy(kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))


def type_gate(nodes: DataFrame, most: float = 0.15) -> DataFrame:
    """One row: nodes, those of type other or unknown, and whether their share is below ``most``."""
    counts = type_distribution(nodes)
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nodes"),
        F.coalesce(F.sum(F.when(F.col("type").isin("other", "unknown"), F.col("n"))), F.lit(0)).alias("open_nodes"),
    ).select("nodes", "open_nodes", (F.col("open_nodes") < most * F.greatest("nodes", F.lit(1))).alias("passed"))


def calls_by_kind(calls: DataFrame) -> DataFrame:
    """(kind, calls, per_paper) of counters (stage, kind, n) summed over stages; ``papers`` is a column of each row."""
    grouped = calls.groupBy("kind").agg(F.sum("n").alias("calls"), F.max("papers").alias("papers"))
    return grouped.select("kind", "calls", ratio("calls", "papers", 2).alias("per_paper"))


def call_kind(prompt: Column) -> Column:
    """What a prompt was for, by its wording."""
    lower = F.lower(prompt)
    return (
        F.when(F.contains(prompt, F.lit(GLEANING)), "glean")
        .when(F.contains(lower, F.lit("summar")), "summary")
        .when(F.contains(lower, F.lit("extract")), "extract")
        .otherwise("other")
    )


def review_sample(rows: DataFrame, key: str, n: int = 100, seed: int = 0) -> DataFrame:
    """All rows if there are at most ``n``, else ``n`` of them in the order of a seeded hash of their key."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.orderBy(order, key).limit(n)


def bands(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(band, verdict, n): candidate pairs (a, b, sim) by hundredths of similarity, rounded down to even, and verdict."""
    joined = pairs.where("sim IS NOT NULL").join(verdicts, ["a", "b"], "left")
    hundredths = F.floor(F.col("sim") * 100)
    return joined.groupBy(
        ((hundredths - hundredths % 2) / 100).alias("band"), F.coalesce("verdict", F.lit("kept separate")).alias("verdict")
    ).agg(F.count(F.lit(1)).alias("n"))


def first_verdicts(aliases: DataFrame) -> DataFrame:
    """(a, b, verdict): the first verdict by seq of each unordered pair of (seq, alias, canonical, verdict)."""
    return (
        aliases.groupBy(F.least("alias", "canonical").alias("a"), F.greatest("alias", "canonical").alias("b"))
        .agg(F.min(F.struct("seq", "verdict")).alias("first"))
        .select("a", "b", "first.verdict")
    )


def new_by_batch(names: DataFrame, size: int) -> DataFrame:
    """(batch, papers, names, new_names) of (paper, name): papers in order of their ids in groups of ``size``.

    A name is new in the first batch that has it. Only distinct papers are numbered.
    """
    from weftgraph.plans.lineage import numbered

    papers, _ = numbered(names.select("paper").where("paper IS NOT NULL").distinct(), ["paper"])
    papers = papers.select("paper", F.floor(F.col("seq") / size).alias("batch"))
    seen = names.where("name IS NOT NULL").join(papers, "paper").groupBy("name", "batch").agg(F.count(F.lit(1)).alias("n"))
    first = seen.withColumn("first", F.min("batch").over(Window.partitionBy("name")))
    counted = first.groupBy("batch").agg(F.count(F.lit(1)).alias("names"), F.count_if(F.col("batch") == F.col("first")).alias("new_names"))
    sizes = papers.groupBy("batch").agg(F.count(F.lit(1)).alias("papers"))
    return sizes.join(counted, "batch", "left").select(
        "batch", "papers", F.coalesce("names", F.lit(0)).alias("names"), F.coalesce("new_names", F.lit(0)).alias("new_names")
    )


def set_difference_by_paper(base: DataFrame, more: DataFrame, shown: int = 15) -> DataFrame:
    """(paper, base_names, more_names, only_more, sample): lower-case names of two runs (paper, name), papers in both."""
    lower = lambda df, flag: df.select("paper", F.lower("name").alias("name")).distinct().withColumn(flag, F.lit(1))
    both = lower(base, "x").join(lower(more, "y"), ["paper", "name"], "full")
    only = F.col("x").isNull()
    place = F.row_number().over(Window.partitionBy("paper", F.col("x").isNull()).orderBy("name"))
    rows = both.withColumn("place", place)
    grouped = rows.groupBy("paper").agg(
        F.count("x").alias("base_names"),
        F.count("y").alias("more_names"),
        F.count_if(only).alias("only_more"),
        F.array_join(F.sort_array(F.collect_list(F.when(only & (F.col("place") <= shown), F.col("name")))), "|").alias("sample"),
    )
    return grouped.where("base_names > 0 AND more_names > 0")
