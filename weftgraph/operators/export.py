"""Tables for use outside of a run: paper-to-concept rows, entity records, neighbour agreement, a map, and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.operators.aliases import resolved


def vector_id(name: str) -> Column:
    """The id of an entity's vector: ``ent-`` and the md5 of its name."""
    return F.concat(F.lit("ent-"), F.md5(F.col(name)))


def document_id(paper: str) -> Column:
    """The id of a paper's document: ``doc-`` and the md5 of its file name."""
    return F.concat(F.lit("doc-"), F.md5(F.concat(F.col(paper), F.lit(".md"))))


def paper_concepts(extracted: DataFrame, nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(arxiv_id, concept, type, extracted_name): each paper's names led through aliases to nodes, once each.

    ``extracted`` has (arxiv_id, name), nodes (name, type), aliases (alias, canonical). Names that lead to no node are
    dropped. Chains are resolved for distinct names only, so a name that most rows hold is resolved once.
    """
    finals = resolved(aliases, extracted.select("name").where("name IS NOT NULL").distinct())
    known = finals.join(nodes.select(F.col("name").alias("final"), "type"), "final")
    rows = extracted.select("arxiv_id", "name").distinct().join(known, "name")
    return rows.select("arxiv_id", F.col("final").alias("concept"), "type", F.col("name").alias("extracted_name"))


def stale_rows(extracted: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row: distinct (paper, name) pairs whose name is still an alias, and all of them."""
    pairs = extracted.select("arxiv_id", "name").where("name IS NOT NULL").distinct()
    flagged = pairs.join(aliases.select(F.col("alias").alias("name"), F.lit(1).alias("stale")), "name", "left")
    return flagged.agg(F.count("stale").alias("stale"), F.count(F.lit(1)).alias("pairs"))


def aliases_by_final(nodes: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, aliases): names that lead to each node, sorted."""
    led = resolved(aliases, aliases.select(F.col("alias").alias("name")))
    kept = led.join(nodes.select(F.col("name").alias("final")), "final", "left_semi").where("name <> final")
    return kept.groupBy(F.col("final").alias("name")).agg(F.sort_array(F.collect_set("name")).alias("aliases"))


def entity_records(nodes: DataFrame, edges: DataFrame, aliases: DataFrame, length: int = 260) -> DataFrame:
    """(name, type, description, papers, degree, neighbours, aliases): a record per node; edges has (src, dst)."""
    ends = edges.select(F.col("src").alias("name"), F.col("dst").alias("n")).unionByName(edges.select(F.col("dst").alias("name"), F.col("src").alias("n")))
    around = ends.groupBy("name").agg(F.sort_array(F.collect_set("n")).alias("neighbours"), F.count(F.lit(1)).alias("degree"))
    names = aliases_by_final(nodes, aliases)
    first = F.substring(F.trim(F.try_element_at("fragments", F.lit(1))), 1, length)
    empty = F.array().cast("array<string>")
    return nodes.join(around, "name", "left").join(names, "name", "left").select(
        "name",
        F.coalesce(F.lower("type"), F.lit("unknown")).alias("type"),
        first.alias("description"),
        F.array_sort(F.array_distinct("papers")).alias("papers"),
        F.coalesce("degree", F.lit(0)).alias("degree"),
        F.coalesce("neighbours", empty).alias("neighbours"),
        F.coalesce("aliases", empty).alias("aliases"),
    )


def agreement(neighbours: DataFrame, labels: DataFrame, first: int = 5) -> DataFrame:
    """One row: the mean over vectors of the share of their first neighbours (id, neighbour, rank) with the same label."""
    near = neighbours.where(F.col("rank") <= first)
    both = near.join(labels.select("id", F.col("label").alias("x")), "id").join(
        labels.select(F.col("id").alias("neighbour"), F.col("label").alias("y")), "neighbour"
    )
    each = both.groupBy("id").agg(F.avg((F.col("x") == F.col("y")).cast("int")).alias("share"))
    return each.agg(F.round(F.avg("share"), 4).alias("agreement"), F.count(F.lit(1)).alias("vectors"))


def plane(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x, y): the first two principal components, scaled to 0 to 1; up to sign the same on every run."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    flat = PCA(k=2, inputCol="v", outputCol="p").fit(rows).transform(rows).select(key, vector_to_array("p").alias("p"))
    ends = flat.agg(*[f(F.col("p")[i]).alias(f"{n}{i}") for i in (0, 1) for n, f in (("low", F.min), ("high", F.max))])
    scaled = [
        F.try_divide(F.col("p")[i] - F.col(f"low{i}"), F.col(f"high{i}") - F.col(f"low{i}")).alias(n) for i, n in ((0, "x"), (1, "y"))
    ]
    return flat.crossJoin(F.broadcast(ends)).select(key, *scaled)  # one row


def shared_papers(neighbours: DataFrame, papers: DataFrame, first: int = 5) -> DataFrame:
    """One row: the mean over names of the share of their first neighbours (id, neighbour, rank) with a common paper.

    ``papers`` has (id, paper), each pair once; common papers are found by a join, so no name's papers are gathered.
    """
    near = neighbours.where(F.col("rank") <= first).select("id", "neighbour")
    own = near.join(papers.select("id", "paper"), "id")
    common = own.join(papers.select(F.col("id").alias("neighbour"), "paper"), ["neighbour", "paper"]).select("id", "neighbour").distinct()
    flagged = near.join(common.withColumn("shared", F.lit(1)), ["id", "neighbour"], "left")
    each = flagged.groupBy("id").agg(F.avg(F.coalesce("shared", F.lit(0))).alias("share"))
    return each.agg(F.round(F.avg("share"), 4).alias("agreement"), F.count(F.lit(1)).alias("names"))


def probes(near: DataFrame, shown: DataFrame, length: int = 420) -> DataFrame:
    """(id, rank, sim, neighbour, title, text): what a search finds (id, neighbour, rank, sim), with the hits' titles and the
    beginnings of their texts (neighbour, title, text)."""
    start = F.substring(F.trim(F.regexp_replace("text", r"\s+", " ")), 1, length)
    return near.join(shown.select("neighbour", "title", start.alias("text")), "neighbour").select("id", "rank", "sim", "neighbour", "title", "text")


def statistics(nodes: DataFrame, edges: DataFrame, papers: DataFrame) -> DataFrame:
    """One row: numbers of entities, edges and different papers (paper)."""
    every = F.count(F.lit(1))
    rows = nodes.agg(every.alias("entities")), edges.agg(every.alias("edges")), papers.agg(F.countDistinct("paper").alias("papers"))
    return rows[0].crossJoin(F.broadcast(rows[1])).crossJoin(F.broadcast(rows[2]))  # single rows


def vector_rows(names: DataFrame, vectors: DataFrame) -> DataFrame:
    """(id, name, meta, vector) for the vectors (id, vector) of names (name, and what else is known of it).

    ``meta`` is the JSON of the names' columns; names without a vector are left out.
    """
    rows = names.select(vector_id("name").alias("id"), "name", F.to_json(F.struct(*names.columns)).alias("meta"))
    return rows.join(vectors.select("id", F.col("vector").cast("array<float>").alias("vector")), "id").select("id", "name", "meta", "vector")


def review_sheet(rows: DataFrame, question: str) -> DataFrame:
    """``rows`` as a sheet for a reviewer: lists joined by " | ", and an empty column named after the question."""
    joined = {f.name: F.array_join(f.name, " | ") for f in rows.schema if f.dataType.typeName() == "array"}
    return rows.withColumns(joined).withColumn(question, F.lit(""))


def sinks(nodes: DataFrame, edges: DataFrame, chunks: DataFrame, concepts: DataFrame, vectors: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    """The tables of an export in their formats, for ``write_all``: graph, vectors, chunks and paper-to-concept rows."""
    lines = chunks.select(F.col("chunk_id").alias("id"), "arxiv_id", F.col("ord").alias("order"), "tokens", "heading", "content")
    return {
        "nodes": (nodes, "parquet"),
        "edges": (edges, "parquet"),
        "vectors_entities": (vector_rows(nodes.select("name", "type"), vectors), "parquet"),
        "chunks": (lines, "json"),
        "paper_concepts": (concepts.select("arxiv_id", "concept", "type", "extracted_name").orderBy("arxiv_id", "concept", "extracted_name"), "csv"),
    }


def write_all(spark: SparkSession, folder: str, tables: dict[str, tuple[DataFrame, str]]) -> None:
    """Write tables as ``folder/name`` in their formats (parquet, json, csv); an existing table is replaced as a whole."""
    for name, (df, kind) in tables.items():
        writer = df.write.mode("overwrite")
        (writer.option("header", True) if kind == "csv" else writer).format(kind).save(f"{folder}/{name}")
