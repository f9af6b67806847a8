"""Every core query with SQL agrees with it; those without have a stable schema (their rows: test_restated)."""

import importlib

import pytest

import __spark_entry__ as entry
from oracle import DATA, compare

MODULES = [importlib.import_module(f"faultlake.plans.{m}") for m in entry.CORE]
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
SQL = {n: s for m in MODULES for n, s in m.SQL.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in SQL:
        compare(spark, name, QUERIES[name], SQL[name])
    else:
        assert QUERIES[name](spark, DATA).schema == QUERIES[name](spark, DATA).schema


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_core_does_not_import_llm():
    from pathlib import Path

    root = Path(entry.__file__).parent / "faultlake"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "faultlake.llm" not in path.read_text(), path
