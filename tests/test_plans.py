"""Plan shape checks: the physical plans we want, not only the right rows."""

import pytest

from __spark_entry__ import queries
from taxaspark.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
MODEL = {"fit_logit", "posterior_draws", "screen_species", "plot_table", "summary_lines"}
# cross joins with a bounded broadcast side: the draws table, a one-row threshold or total
CROSS_OK = {"posterior_interval", "fnr_curve", "threshold_for_fnr", "threshold_edge_groups", "confident_list"}
# single-partition exchanges only for one-row totals and the per-bucket / per-range offsets
# (one row per bucket or range partition: bounded by a parameter, not by the data)
SINGLE_OK = {"flag_summary", "fnr_curve", "threshold_for_fnr", "threshold_edge_groups", "confident_list", "row_index",
             "locality_fill_ordered", "posterior_interval", "newton_sums"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - MODEL))
def test_plan_shape(spark, name):
    p = _plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    if name not in CROSS_OK:
        assert "BroadcastNestedLoopJoin" not in p
    if name not in SINGLE_OK:
        assert "SinglePartition" not in p


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(queries()["join_semi"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in p


def test_first_per_key_limits_before_shuffle(spark):
    p = _plan(queries()["first_per_key"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_null_safe_join_is_an_equi_join(spark):
    p = _plan(queries()["join_left"](spark, SF))
    assert ("BroadcastHashJoin" in p or "SortMergeJoin" in p) and "NestedLoop" not in p
