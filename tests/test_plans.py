"""Plan shape: no cartesian products or nested-loop joins anywhere, filters and
pruning reach the scan, lag windows are keyed by bucket."""

import pytest

from meteoframe.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_date_window_pushed_to_scan(spark):
    plan = _plan(QUERIES["context_window"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate" in plan
    assert "o_orderstatus" not in plan  # pruned: never read


def test_point_lookup_pushed_to_stage_scan(spark):
    plan = _plan(QUERIES["observation_on_date"](spark, SF_SMALL))
    assert "EqualTo(obs_date," in plan
