"""Every query over the library's own operators against its SQL on the same tables."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from stormgrid.checks.oracle import ORACLE
from stormgrid.checks.queries import QUERIES


@pytest.fixture(scope="session")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    got = compare.spark_rows(queries()[name](spark, sf_dir))
    want = compare.duck_rows(db, oracle_sql()[name])
    assert not compare.differences(got, want)
    assert got[1], "a query without rows checks nothing"


def test_entry(spark):
    assert entry(spark).count() == 10
