"""The registered queries beside their SQL, the pipeline, and the guard around them."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_names():
    assert sorted(queries.REGISTRY, key=lambda n: int(n[2:].split("_")[0])) == list(queries.REGISTRY)
    assert [int(n[2:].split("_")[0]) for n in queries.REGISTRY] == list(range(1, 14))
    assert {*queries.REGISTRY, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted([*queries.REGISTRY, "pipeline"]))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, name, SF)
    assert ok, note


def test_missing_operators_are_left_out(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.raises(ModuleNotFoundError):
        import corpus_pipeline  # noqa: F401
    assert "pipeline" not in entry.queries() and "market_overview" in entry.queries()
