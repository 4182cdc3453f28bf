"""Every query of the library against its SQL in DuckDB, on the smallest tables.

Queries of the training-data operators are tested in ``tests/llm``.
"""

import pytest

import __spark_entry__ as registered
from reviewcraft.plans.oracles import ORACLES
from reviewcraft.plans.queries import QUERIES
from tests.compare import compare, connect

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, DATA, QUERIES[name], ORACLES[name]) == ""


def test_entry_returns_contexts(spark):
    assert registered.entry(spark).count() > 0
