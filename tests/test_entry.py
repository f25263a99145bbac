import importlib.util
import sys

import __spark_entry__ as entry
from tributary.plans.queries import QUERIES


def test_every_query_with_sql_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_the_rest_works_without_the_training_data_folder(monkeypatch):
    real = importlib.util.find_spec
    gone = ("tributary.llm", "corpus_pipeline")
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in gone else real(name, *a))
    for name in [m for m in sys.modules if m.startswith(gone)]:
        monkeypatch.delitem(sys.modules, name)
    assert set(entry.queries()) == set(QUERIES)
    assert set(entry.oracle_sql()) == set(QUERIES)
    assert not [m for m in sys.modules if m.startswith(gone)]
