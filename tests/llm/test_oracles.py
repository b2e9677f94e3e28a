"""The queries that SQL can express, side by side with their SQL."""

import pytest

from namepulse.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE_SQL[name]) is None
