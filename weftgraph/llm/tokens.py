"""Token counts by public tokenizers, whose files are outside of this repository."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Where the vocabulary files are; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the published pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, Callable[[str], list[int]]] = {}


def encoder(path: str) -> Callable[[str], list[int]]:
    """The tokenizer of a rank file, loaded once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _LOADED[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _LOADED[path]


def with_token_counts(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(keys, n_tokens): tokens of each whole text; null and empty texts have 0. Other columns are left out."""
    rows = df.select(*keys, df[text].alias("__text"))
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("n_tokens", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.columns[-1].to_pylist()]
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)
