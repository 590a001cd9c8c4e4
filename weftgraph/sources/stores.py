"""Reading and writing a run's tables: manifest, alias table, stop names, documents, chunks and cached answers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans.versions import Versions

#: Columns of the alias table's CSV.
ALIASES = "alias string, canonical string, verdict string, date string, cluster_id string, method string, reason string"


def snapshot(df: DataFrame, folder: str, keep: int = 3) -> int:
    """Replace the table in ``folder`` by one atomic step; returns the number of the new version.

    Each version is a folder of its own, and readers take the last one that is published, so there is a whole table at any
    time, also after a crash. A writer that another one has overtaken raises ``Conflict``. The data of the last ``keep``
    versions stay, for those who still read them.
    """
    versions = Versions(df.sparkSession, f"{folder}/versions")
    number, data = versions.latest() + 1, f"{folder}/data/{uuid.uuid4().hex}"
    df.write.parquet(data)
    versions.publish(number, data)
    if number >= keep:
        versions.remove(versions.read(number - keep))
    return number


def snapshot_or_empty(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The table in ``folder``, or an empty one before the first version; a version that can't be read raises."""
    versions = Versions(spark, f"{folder}/versions")
    last = versions.latest()
    return spark.createDataFrame([], schema) if last < 0 else spark.read.schema(schema).parquet(versions.read(last))


def alias_csv(spark: SparkSession, path: str) -> DataFrame:
    """An alias table's CSV with ``seq``, the order of its rows within and over its files."""
    rows = spark.read.schema(ALIASES).option("header", True).option("multiLine", True).csv(path)
    return rows.withColumn("seq", F.monotonically_increasing_id())


def with_alias_defaults(rows: DataFrame) -> DataFrame:
    """All columns of the alias table: today's date where none is given, empty text for what is missing."""
    given = {c.lower() for c in rows.columns}
    columns = []
    for name in (part.split()[0] for part in ALIASES.split(", ")):
        default = F.date_format(F.current_date(), "yyyy-MM-dd") if name == "date" else F.lit("")
        columns.append(F.coalesce(F.col(name), default).alias(name) if name in given else default.alias(name))
    return rows.select(*columns)


def stop_names(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a text file with a name a line; blank lines and those that begin with # are left out."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~F.col("value").startswith("#")).select(line.alias("name"))


def processed_documents(status: DataFrame) -> DataFrame:
    """(doc_id, arxiv_id, chunks_count, chunks) of processed documents; the paper is the file's stem, or else the document."""
    stem = F.nullif(F.regexp_extract(F.coalesce("file_path", F.lit("")), r"([^/]*?)(\.[^./]*)?$", 1), F.lit(""))
    return status.where(F.lower("status").endswith("processed")).select(
        "doc_id",
        F.coalesce(stem, "doc_id").alias("arxiv_id"),
        F.coalesce("chunks_count", F.lit(0)).alias("chunks_count"),
        F.coalesce("chunks_list", F.array().cast("array<string>")).alias("chunks"),
    )


def by_ids(store: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a store with the wanted ids; missing ids are left out."""
    return store.join(ids.select(key).distinct(), key, "left_semi")


def extracted_names(documents: DataFrame, entities: DataFrame) -> DataFrame:
    """(arxiv_id, name) of the entity names (doc_id, entity_names) of processed documents."""
    return documents.select("doc_id", "arxiv_id").join(entities, "doc_id").select("arxiv_id", F.explode("entity_names").alias("name"))


def cached_answers(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Cached model calls of chunks (chunk_id, llm_cache_list); the owner stands in where an answer has no chunk."""
    keys = chunks.select(F.col("chunk_id").alias("owner"), F.explode("llm_cache_list").alias("key"))
    rows = keys.join(cache, "key")
    return rows.withColumn("chunk_id", F.coalesce("chunk_id", "owner")).drop("owner")
