"""Every registered query next to its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from check_oracles import compare, connect

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf, name):
    ok, note = compare(spark, con, QUERIES[name], ORACLES[name], sf)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
