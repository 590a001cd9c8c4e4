"""The driver's contract, with and without the subpackage for training data."""

import importlib
import os
import sys

import pytest

DATA = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 40


def test_without_subpackage(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("weftgraph.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "weftgraph.llm", None)
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    assert "code_merges" in entry.queries() and "p6_found" in entry.queries() and "p1_found" not in entry.queries()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_flagship(spark):
    entry = importlib.import_module("__spark_entry__")
    found = entry.entry(spark)
    assert found.columns == ["name", "canonical", "key", "type"] and found.count() > 0
