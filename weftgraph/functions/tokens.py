"""Token counters for the core: any function from a text to a number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TokenCounter = Callable[[str], int]

#: Words in pieces of at most six letters, numbers in pieces of three digits, and single signs.
PIECE = r"\p{L}{1,6}|\p{Nd}{1,3}|[^\p{L}\p{Nd}\s]"


def pieces(text: Column) -> Column:
    """A deterministic stand-in for a subword tokenizer, for use without vocabulary files; no piece reaches over a blank."""
    return F.regexp_count(text, F.lit(PIECE)).cast("bigint")


def vocabulary_counter(path: str, pattern: str) -> TokenCounter:
    """Counts by a rank file of a public byte-level vocabulary; ``pattern`` splits a text before merging."""
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("core", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))
