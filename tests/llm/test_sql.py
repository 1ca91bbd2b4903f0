import pytest

from oracle import connect, difference
from ratewright.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, small, name):
    assert difference(queries.QUERIES[name](spark, small), connect(small), queries.SQL[name]) is None
