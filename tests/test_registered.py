"""Every registered query agrees with its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql
from check import compare, connect
from oracle.sql import ORACLE
from tidemark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, SF, oracle_sql()[name])
    assert ok, note


def test_entry(spark):
    assert entry(spark).columns == ["revenue_month", "total_revenue", "total_orders"]
