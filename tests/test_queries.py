"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, difference

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name], ORACLES[name], spark, duck, sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
