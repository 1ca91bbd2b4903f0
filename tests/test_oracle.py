"""Every registered query against its flat SQL."""

import pytest

import __spark_entry__ as E
from oracle import connect, difference
from ratewright.plans import catalog


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, small, con, name):
    assert name in E.oracle_sql()
    assert difference(E.queries()[name](spark, small), con, E.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert E.entry(spark).count() > 0
