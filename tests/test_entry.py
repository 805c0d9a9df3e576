import importlib
import sys

import __spark_entry__ as entry


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 40


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 27


def test_imports_without_the_llm_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "hirelens.llm", None)
    for name in [n for n in sys.modules if n.startswith("hirelens.llm.") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    again = importlib.reload(entry)
    assert "report_by_year" in again.queries() and not any(n.startswith("op") and n[2].isdigit() for n in again.queries())
    monkeypatch.undo()
    importlib.reload(entry)
