"""Every registered query against its SQL on whole tables."""

import pytest

import __spark_entry__ as driver
import compare
from tidemark.plans import catalog

QUERIES, EXPECTED = catalog.QUERIES, catalog.EXPECTED


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(driver.queries()) and set(EXPECTED) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    assert compare.difference(QUERIES[name](spark, small), con, EXPECTED[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 15


def test_one_shuffle_for_the_whole_history(spark, small):
    plan = QUERIES["scd2_build"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["lookback_seeded", "scd2_merge", "dim_merge", "scd_as_of_join", "stream_scd2_history"])
def test_without_broadcast_joins(spark, small, con, name):
    """Real histories are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.difference(QUERIES[name](spark, small), con, EXPECTED[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
