"""Every registered query against its SQL counterpart on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from harness import queries as harness_queries
from harness.oracle import oracle as harness_oracle
from tests.compare import connect, differences
from tests.conftest import SMALL

QUERIES, ORACLE = harness_queries.QUERIES, harness_oracle()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("query", QUERIES)
def test_query(spark, duck, query):
    assert differences(QUERIES[query](spark, SMALL), duck, ORACLE[query]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
