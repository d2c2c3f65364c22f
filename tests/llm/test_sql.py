"""Registered corpus queries against DuckDB, and their registration."""

import pytest

import __spark_entry__ as entry_module
from tallymart.llm import registry
from tests.compare import connect, difference

SQL = registry.oracle_sql()


def test_every_operator_is_registered():
    queries = entry_module.queries()
    numbers = {int(name[2:].split("_")[0]) for name in registry.queries()}
    assert numbers == set(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= set(queries)
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_small, sf_medium, name):
    directory = sf_medium if name != "op2_projection_dedup" else sf_small
    query = registry.queries()[name]
    assert difference(query(spark, directory), connect(directory), SQL[name]) is None
