"""The queries that SQL can express, against that SQL on the same tables."""

import pytest

from ledgerlens.llm import queries
from tools.check_queries import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", queries.SQL)
def test_query_equals_sql(spark, duck, key):
    assert compare(queries.QUERIES[key](spark, SMALL), duck, queries.SQL[key]) is None
