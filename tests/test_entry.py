"""Registration with and without the training-data operators."""
import builtins
import importlib

import pytest


def test_other_queries_register_where_the_subpackage_cannot_be_imported(monkeypatch):
    import __spark_entry__ as E
    real = builtins.__import__

    def refuse(name, *a, **k):
        if name.startswith(("qbank.llm", "corpus_pipeline")):
            raise ImportError(name)
        return real(name, *a, **k)
    monkeypatch.setattr(builtins, "__import__", refuse)
    names = set(E.queries())
    assert names == set(E.oracle_sql()) and "main_texts" in names
    assert not any(n.startswith("op") or n == "pipeline" for n in names)


def test_every_query_of_the_reference_has_sql():
    import __spark_entry__ as E
    from qbank.plans.registry import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    try:
        importlib.import_module("qbank.llm.queries")
    except ImportError:
        pytest.skip("without the training-data operators")
    assert set(E.oracle_sql()) <= set(E.queries())
