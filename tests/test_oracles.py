"""Every SQL-checkable query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

from chronofit.plans.catalog import oracle_sql, queries
from conftest import SF_SMALL
from oracle_harness import compare, duck

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, queries()[name], ORACLES[name], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    import importlib.util
    import os
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(mod.oracle_sql()) <= set(mod.queries())


@pytest.mark.parametrize("name", ["loads_fixture", "baseline_segment_errors"])
def test_oracle_on_freshly_built_loads(spark, con, name):
    """Ranking and medians end to end on ``loads`` as built, without the written fixture."""
    from chronofit.functions.metrics import round_doubles
    from chronofit.operators.baselines import group_median_rpm
    from chronofit.operators.errors import holdout_errors, segment_errors
    from chronofit.operators.split import inner_split, outer_split
    from chronofit.sources import fixture

    def forced(spark, sf):
        loads = fixture.build_loads(spark, sf)
        if name == "loads_fixture":
            return round_doubles(loads)
        dev = loads.where("date < DATE'2000-07-01'").drop(
            "pickup_key", "delivery_key")
        val = loads.where("date >= DATE'2000-07-01'").drop("pickup_key", "delivery_key", "posted_rate")
        plan = outer_split(dev, val, min_rows=100)
        tr, ho = plan.training(dev), plan.holdout(dev)
        return round_doubles(segment_errors(holdout_errors(group_median_rpm(tr, ho), tr)))

    r = compare(spark, name, SF_SMALL, forced, ORACLES[name], con)
    assert r["columns_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r
