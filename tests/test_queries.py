"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
ORACLE = entry.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
