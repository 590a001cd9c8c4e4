"""Vectors of texts from a provider, in batches that are checked and brought to length 1."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.operators.decisions import EmbeddingProvider

#: Texts of one request, and how often a request is tried.
BATCH, TRIES = 32, 8


def tried(call: Callable, tries: int = TRIES, wait: Callable[[float], None] = time.sleep):
    """What ``call`` gives, tried again after errors with waits of 2, 4, 8 ... up to 60 seconds; the last error is raised."""
    for n in range(1, tries):
        try:
            return call()
        except Exception:
            wait(min(60.0, 2.0**n))
    return call()


def _vectors(provider: EmbeddingProvider, texts: list[str]) -> list[list[float]]:
    found = provider.embed(texts)
    if len(found) != len(texts):
        raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
    rows = np.asarray(found, dtype=np.float64).reshape(len(texts), -1)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(norms > 0, norms, 1)).tolist()


def embedded(df: DataFrame, key: str, text: str, provider: EmbeddingProvider, batch: int = BATCH, tries: int = TRIES) -> DataFrame:
    """(key, vector): one vector of length 1 for each text; a provider that gives another number of vectors fails.

    Requests hold up to ``batch`` texts; a task sends its requests one after the other, so partitions bound the requests at
    once. Null texts are left out, empty ones are sent as they are.
    """
    rows = df.select(key, F.col(text).alias("__text")).where("__text IS NOT NULL")
    kind = rows.schema[key].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for low in range(0, len(part), batch):
                some = part.iloc[low : low + batch]
                texts = some["__text"].tolist()
                yield pd.DataFrame({key: some[key].to_numpy(), "vector": tried(lambda t=texts: _vectors(provider, t), tries)})

    return rows.mapInPandas(run, f"`{key}` {kind}, vector array<double>")
