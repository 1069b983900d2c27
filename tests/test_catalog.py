"""Each registered query gives what its SQL gives on the driver's tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from tablebind import catalog

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
