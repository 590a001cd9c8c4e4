"""Names and relations that a provider finds in chunks, and the graph they make."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ExtractionProvider(Protocol):
    """Finds in a text entities (name, type, description) and relations (name, name, description)."""

    def extract(self, text: str) -> tuple[list[tuple[str, str, str]], list[tuple[str, str, str]]]: ...


class PatternExtractor:
    """A deterministic stand-in for a language model: names are runs of capitalised words and acronyms.

    The description of a name is the sentence it stands in; names of one sentence are related to the one before.
    """

    _NAME = re.compile(r"\b(?:[A-Z][\w+-]+(?: [A-Z][\w+-]+)+|[A-Z]{2,}[\w+-]*|[A-Z][a-z]+[A-Z][\w+-]*)")

    def extract(self, text: str) -> tuple[list[tuple[str, str, str]], list[tuple[str, str, str]]]:
        entities, relations = [], []
        for sentence in re.split(r"(?<=[.!?])\s+", text):
            names = list(dict.fromkeys(self._NAME.findall(sentence)))
            entities += [(n, "other", sentence.strip()) for n in names]
            relations += [(a, b, sentence.strip()) for a, b in zip(names, names[1:])]
        return entities, relations


_FOUND = "chunk_id string, arxiv_id string, kind string, name string, other string, description string"


def extracted(chunks: DataFrame, provider: ExtractionProvider) -> DataFrame:
    """(chunk_id, arxiv_id, kind, name, other, description): entities, with their type in ``other``, and relations of chunks.

    One call a chunk; a task asks for its chunks one after the other. Chunks without findings give no rows.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for chunk, paper, text in zip(part["chunk_id"], part["arxiv_id"], part["content"]):
                for kind, found in zip(("entity", "relation"), provider.extract(text)):
                    rows += [(chunk, paper, kind, *row) for row in found]
            yield pd.DataFrame(rows, columns=["chunk_id", "arxiv_id", "kind", "name", "other", "description"])

    return chunks.select("chunk_id", "arxiv_id", "content").mapInPandas(run, _FOUND)


def graph_of(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (name, type, fragments, source_ids, files) and edges (src, dst, weight, description) of what was extracted.

    A node's type is the one most chunks give (ties: the greater); an edge's weight is the number of chunks that relate its
    ends, in either direction.
    """
    entities = found.where("kind = 'entity' AND trim(name) <> ''").withColumn("name", F.trim("name"))
    votes = entities.groupBy("name", F.lower("other").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    types = votes.groupBy("name").agg(F.max(F.struct("n", "type")).alias("best")).select("name", "best.type")
    lists = entities.groupBy("name").agg(
        F.sort_array(F.collect_set("description")).alias("fragments"),
        F.sort_array(F.collect_set("chunk_id")).alias("source_ids"),
        F.sort_array(F.collect_set(F.concat("arxiv_id", F.lit(".md")))).alias("files"),
    )
    ends = found.where("kind = 'relation'").select(
        F.least(F.trim("name"), F.trim("other")).alias("src"), F.greatest(F.trim("name"), F.trim("other")).alias("dst"), "chunk_id", "description"
    )
    edges = ends.where("src <> dst AND src <> ''").groupBy("src", "dst").agg(
        F.countDistinct("chunk_id").cast("double").alias("weight"), F.array_join(F.sort_array(F.collect_set("description")), "<SEP>").alias("description")
    )
    return types.join(lists, "name"), edges
