"""Plan shape of every catalog query: native expressions, no all-pairs joins,
size-checked joins broadcast at test scale, filters and projections at the scan."""

import pytest

from veloframe.plans.queries import QUERIES

# These fit models while being built; their plans are checked through the
# feature and encoding queries they are made of.
FITTING = {"rf_accuracy", "dt_accuracy", "lr_accuracy", "job_baseline", "job_window_features",
           "job_all_features", "stream_trip_periods", "trees_by_terminal", "window_job_by_terminal",
           "all_features_by_terminal", "lr_scored", "dt_rules", "rf_rules", "lr_optimality", "job_baseline_lr",
           "job_window_lr", "job_all_features_lr", "job_random_split"}
# Stored sides: joined bucket by bucket, or two stored results compared.
MERGED = {"bucketed_shares", "fitted_scored"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTING))
def test_plan_shape(spark, small_dir, name):
    plan = _plan(QUERIES[name](spark, small_dir))
    assert "BatchEvalPython" not in plan
    assert "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert name in MERGED or "SortMergeJoin" not in plan


def test_scan_reads_only_needed_columns(spark, small_dir):
    df = QUERIES["trips_per_weekday"](spark, small_dir)
    plan = _plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
