"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from tidewater.workloads import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, sf, name):
    made = []

    def run(*args):
        made.append(driver.queries()[name](*args))
        return made[0]

    assert compare(spark, con, run, driver.oracle_sql()[name], sf) is None
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0
