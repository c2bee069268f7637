"""Every registered query against its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, oracle_connection
from wicklake.catalog.oracles import ORACLES
from wicklake.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def oracle(small):
    return oracle_connection(small)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, small, name):
    problem, rows, _ = compare(spark, oracle, small, name, QUERIES[name], ORACLES[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["symbol", "open_time", "close_price"]
