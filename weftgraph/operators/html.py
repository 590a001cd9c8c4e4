"""Web pages to Markdown as a DataFrame operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.html import to_markdown
from weftgraph.operators.text import per_text


def pages_to_markdown(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """(keys, title, markdown) of each page; null pages give no row."""
    schema = "title string, markdown string"

    def rows(value: str):
        title, markdown = to_markdown(value)
        yield {"title": title, "markdown": markdown}

    return per_text(df, keys, html, schema, rows)


def worth_keeping(df: DataFrame, markdown: str = "markdown", least_words: int = 2500) -> DataFrame:
    """Rows whose Markdown has enough words and a list of references."""
    words = F.size(F.filter(F.split(markdown, r"\s+"), lambda w: w != ""))
    return df.where((words >= least_words) & F.col(markdown).contains("## References"))
