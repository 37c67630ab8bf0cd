"""Every query of the catalogue against its oracle on the smallest tables."""

import pytest
from conftest import SF, assert_same

from weirlake.plans import catalogue, decisions, discovery, matching, releases, roundtrips  # noqa: F401


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_oracle(spark, oracle, name):
    assert_same(catalogue.QUERIES[name](spark, SF), oracle.sql(catalogue.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_filters_reach_the_scan(spark):
    plan = catalogue.QUERIES["keyset_page"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(user_id,20)" in plan
    assert "ts" not in plan.split("ReadSchema")[1]
