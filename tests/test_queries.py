import builtins
import importlib
import sys

import pytest

import __spark_entry__ as entry
import oracle_queries
from oracle_check import compare, oracle

NAMES = list(oracle_queries.all_queries())


@pytest.fixture(scope="module")
def con(sf_folder):
    return oracle(sf_folder)


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, con, sf_folder, name):
    assert compare(spark, con, name, sf_folder) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_the_text_operators_can_be_left_out(monkeypatch):
    """Without their subpackage the other queries stay."""
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name in ("corpus_pipeline", "tallyhouse.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kwargs)

    for name in [n for n in sys.modules if n.startswith(("tallyhouse.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    with monkeypatch.context() as patched:
        patched.setattr(builtins, "__import__", without)
        bare = importlib.reload(entry)
        assert set(bare.queries()) == set(NAMES) == set(bare.oracle_sql())
    importlib.reload(entry)
