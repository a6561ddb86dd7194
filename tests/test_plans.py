"""Physical-plan properties: pushdown, pruning, broadcast of proven-small state only."""

from pyspark.sql import functions as F

from chronofit.operators import features as FE
from chronofit.plans.context import context, fitted_state
from conftest import SF_SMALL


def _plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")     # untruncated scan metadata
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_split_filters_reach_the_scan(spark):
    c = context(spark, SF_SMALL)
    plan = _plan(c.holdout.select("load_id", "distance"))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date" in plan
    assert "LessThan(date" in plan                               # the labeled table's filter too
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "posted_rate" not in read and "equipment" not in read  # 2-column projection prunes the scan


def test_state_lookups_broadcast_when_small(spark):
    c = context(spark, SF_SMALL)
    st = fitted_state(spark, SF_SMALL)
    out = FE.transform(st, c.holdout, ["route_frequency", "pickup_lat"], keep=["load_id"])
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_state_lookups_fall_back_to_shuffle_above_the_bound(spark):
    c = context(spark, SF_SMALL)
    st = fitted_state(spark, SF_SMALL)
    spark.conf.set("chronofit.broadcast_rows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(FE.transform(st, c.holdout, ["route_frequency"], keep=["load_id"]))
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("chronofit.broadcast_rows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_segment_errors_single_aggregate(spark):
    from chronofit.plans.q_relational import baseline_errors
    from chronofit.operators.errors import segment_errors
    plan = _plan(segment_errors(baseline_errors(spark, SF_SMALL)))
    assert plan.count("Expand") == 1                            # GROUPING SETS, not six group-bys


def test_few_valued_keys_never_shuffle_the_rows(spark):
    from chronofit.operators.baselines import group_median_rpm
    from chronofit.operators.errors import holdout_errors
    c = context(spark, SF_SMALL)
    plan = _plan(holdout_errors(group_median_rpm(c.training, c.holdout), c.training))
    assert plan.count("BroadcastHashJoin") >= 4
    assert "hashpartitioning(__g" not in plan and "hashpartitioning(__p" not in plan and "hashpartitioning(__d" not in plan
