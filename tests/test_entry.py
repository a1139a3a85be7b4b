"""The driver contract holds with and without the training-data subpackage."""

import importlib
import sys


def test_entry_without_llm(monkeypatch):
    import __spark_entry__ as entry
    with_llm = set(entry.queries())
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "ordermill.llm", None)
    monkeypatch.setitem(sys.modules, "ordermill.llm.queries", None)
    entry = importlib.reload(entry)
    names = set(entry.queries())
    assert "rpt_sales_summary" in names and names <= with_llm
    assert not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in names)
    assert set(entry.oracle_sql()) <= names
    monkeypatch.undo()
    importlib.reload(entry)
