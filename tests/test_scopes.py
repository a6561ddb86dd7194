"""States and baselines of many training windows equal those fitted window by window."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronofit import constants as K
from chronofit.operators import features as FE
from chronofit.operators.baselines import global_median, group_median_rpm, scoped_baselines
from chronofit.operators.quantiles import exact_quantiles
from chronofit.operators.split import Scope, holdout_rows, scope_sizes, time_part, training_windows
from chronofit.plans.context import context, fitted_state
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def ctx(spark):
    return context(spark, SF_SMALL)


def test_states_of_all_windows_equal_separate_fits(spark, ctx):
    for s in ctx.state_scopes:
        rows = ctx.development.where(F.col("date") < F.lit(s.before))
        alone, shared = FE.fit(rows), fitted_state(spark, SF_SMALL, s.name)
        assert (alone.reference_date, alone.rows, alone.medians) == (shared.reference_date, shared.rows, shared.medians)
        assert (alone.counts_rows, alone.coordinates_rows) == (shared.counts_rows, shared.coordinates_rows)
        for name in ("counts", "coordinates"):
            a, b = (sorted(map(tuple, getattr(st, name).select(sorted(getattr(st, name).columns)).collect())) for st in (alone, shared))
            assert a == b


def test_quantiles_of_windows_count_rows_once(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.rand(5).alias("v"), (F.col("id") % 7).cast("int").alias("part"))
    windows = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2), ("c", 6)], "window string, part int")
    got = {(r.window, r.g): (r.q, r.m) for r in exact_quantiles(df, ["g"], "v", [0.1, 0.5], ["q", "m"], windows).collect()}
    for w, parts in {"a": [0, 1], "b": [0, 1, 2], "c": [6]}.items():
        for r in df.where(F.col("part").isin(parts)).groupBy("g").agg(F.percentile("v", 0.1).alias("q"), F.percentile("v", 0.5).alias("m")).collect():
            assert got.pop((w, r.g)) == pytest.approx((r.q, r.m), abs=1e-12)
    assert not got
    plan = exact_quantiles(df, ["g"], "v", [0.5], ["m"], windows)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_baselines_of_scopes_equal_separate_ones(spark, ctx):
    got = {}
    for r in scoped_baselines(ctx.development, ctx.baseline_scopes).select("scope", K.ID, "global_median", "group_median").collect():
        got[r.scope, r[K.ID]] = (r.global_median, r.group_median)
    for s in ctx.baseline_scopes:
        tr = ctx.development.where(F.col("date") < F.lit(s.before))
        ho = ctx.development.where(F.col("date").between(F.lit(s.start), F.lit(s.end)))
        a = {r[K.ID]: r.predicted for r in global_median(tr, ho).collect()}
        b = {r[K.ID]: r.predicted for r in group_median_rpm(tr, ho).collect()}
        assert a and all(got.pop((s.name, i)) == pytest.approx((a[i], b[i])) for i in a)
    assert not got


def test_parts_windows_and_sizes(spark):
    day = dt.date
    scopes = [Scope("a", day(2024, 1, 10), day(2024, 1, 10), day(2024, 1, 20)), Scope("b", day(2024, 1, 5), day(2024, 1, 5), day(2024, 1, 12)),
              Scope("c", day(2024, 1, 10), day(2024, 2, 1), day(2024, 2, 2))]
    df = spark.createDataFrame([(day(2024, 1, d),) for d in range(1, 31)], "date date")
    parts = {r.date.day: r.p for r in df.select("date", time_part(scopes).alias("p")).collect()}
    assert parts == {d: 0 if d < 5 else 1 if d < 10 else 2 for d in range(1, 31)}
    assert sorted(map(tuple, training_windows(spark, scopes).collect())) == [("a", 0), ("a", 1), ("b", 0), ("c", 0), ("c", 1)]
    assert sorted(map(tuple, scope_sizes(df, scopes).collect())) == [("a", 9, 11), ("b", 4, 8), ("c", 9, 0)]
    assert holdout_rows(df, scopes).groupBy("scope").count().collect().__len__() == 2


def test_guards_and_fit_transform(spark, ctx):
    state, out = FE.fit_transform(ctx.inner_training, ["distance", "route_frequency"])  # C24, E9
    assert out.columns[-2:] == ["distance", "route_frequency"] and out.count() == state.rows
    with pytest.raises(ValueError):
        FE.transform(state, ctx.holdout, ["no_such_feature"])
    bad = ctx.inner_training.withColumn("date", F.when(F.col("weight") > 20000, F.lit(None).cast("date")).otherwise(F.col("date")))
    with pytest.raises(ValueError):
        FE.fit(bad)
    with pytest.raises(ValueError):
        FE.fit_scopes(bad, [Scope("x", dt.date(2030, 1, 1))])


def test_names_are_normalised_per_distinct_text(spark):
    from chronofit.functions.clean import base_clean
    rows = [(" new  york", "o'hare", "dry van"), ("New York ", None, ""), (None, " ", "REEFER"), ("", "st.louis", None), (" new  york", "o'hare", "dry van")]
    df = spark.createDataFrame([(*r, "2024-01-01", float(i)) for i, r in enumerate(rows)], "pickup string, delivery string, equipment string, date string, distance double")
    for part in (df, df.select("pickup", "date", "distance"), df.select("date", "distance")):
        got, want = FE._clean(part), base_clean(part)
        assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = FE._clean(df)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan
