"""Every named query with a SQL twin gives the same rows in both engines."""

import pytest

import __spark_entry__ as contract
from oracle import connect, difference

QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_rows(name, spark, sf_dir, connection):
    assert difference(QUERIES[name](spark, sf_dir), connection, TWINS[name]) is None


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:2] == ["player_id", "churned"] and not frame.isEmpty()
