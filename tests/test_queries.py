"""Every query against its SQL on the smallest tables."""

import os

import pytest

from namepulse.plans import catalogue, oracles
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_sql(spark, con, name):
    result = catalogue.queries()[name](spark, SF_DIR)
    assert difference(result, con, oracles.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracles.oracle_sql())


def test_entry_is_the_daily_top(spark):
    import __spark_entry__ as contract

    result = contract.entry(spark)
    assert result.columns == ["date", "rn", "word", "total"]
    assert result.agg({"rn": "max"}).first()[0] == 10
