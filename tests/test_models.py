"""Model invariants on the sf0.001 fixture (spark.ml results are not SQL-expressible)."""

import pytest
from pyspark.sql import functions as F

from chronofit import constants as K
from chronofit.operators.contracts import prediction_contract
from chronofit.plans.catalog import queries
from chronofit.plans.workflow import workflow
from chronofit.sources import fixture
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def wf(spark):
    return workflow(spark, SF_SMALL)


def test_leaderboard_selects_best_eligible_and_beats_baseline(wf):
    board = {r.model: r for r in wf.main_board.collect()}
    sel = [m for m, r in board.items() if r.selected]
    assert len(sel) == 1 and board[sel[0]].eligible
    assert board[sel[0]].mae == min(r.mae for r in board.values() if r.eligible)
    assert board[sel[0]].mae < board["equipment_median_rpm"].mae < board["global_median"].mae
    assert not board["global_median"].selected and not board["global_median"].eligible


def test_selection_contracts_clean(wf):
    assert {r.check: r.violations for r in wf.main_contract().collect() if r.violations} == {}


def test_screening_picks_one_set(wf):
    rows = wf.screening.collect()
    assert len(rows) == len(K.COMMON_FEATURE_SETS)
    assert sum(r.selected_for_outer_comparison for r in rows) == 1
    best = min(rows, key=lambda r: (r.selection_score_mean_mae, r.feature_set))
    assert best.selected_for_outer_comparison


def test_distance_is_most_important(wf):
    imp = wf.importance().orderBy(F.col("importance").desc()).first()
    assert imp.feature == "distance" and imp.importance > 0


def test_validation_predictions_contract(spark, wf):
    out = wf.validation_predictions()
    assert out.where(F.col(K.PREDICTION) < 1.0).count() == 0
    checks = prediction_contract(out, fixture.template(spark, SF_SMALL), wf.ctx.validation)
    assert {r.check: r.violations for r in checks.collect() if r.violations} == {}


def test_scenario_predictions_positive(wf):
    rows = wf.scenario_predictions().collect()
    assert len(rows) >= 28 and all(r[K.PREDICTION] >= 1.0 for r in rows)


def test_stability_folds(wf):
    rows = wf.stability().collect()
    assert len(rows) == K.STABILITY_FOLDS and all(r.mae > 0 for r in rows)


def test_stream_equals_batch(spark):
    df = queries()["streaming_scoring"](spark, SF_SMALL)
    r = df.agg(F.count("*").alias("n"), F.count("predicted_rate").alias("s"),
               F.count_if(~F.col("predicted_rate").eqNullSafe(F.col("batch_predicted_rate"))).alias("diff")).first()
    assert r.n == r.s == fixture.validation(spark, SF_SMALL).count() and r.diff == 0


def test_same_seed_same_model(spark, wf):
    from chronofit.operators import models as M
    cols = K.COMMON_FEATURE_SETS["basic_supplied"]
    a = M.predict(M.fit(wf.outer_train, cols, M.PARAMETERS["forest"]), wf.outer_holdout)
    b = M.predict(M.fit(wf.outer_train, cols, M.PARAMETERS["forest"]), wf.outer_holdout)
    j = a.select("load_id", F.col("predicted").alias("x")).join(b.select("load_id", F.col("predicted").alias("y")),
                                                                  "load_id")
    assert j.where(F.col("x") != F.col("y")).count() == 0


def test_saved_bundle_scores_like_the_live_model(wf):
    df = wf.bundle_roundtrip()
    r = df.agg(F.count("*").alias("n"),
               F.count_if(~F.col(K.PREDICTION).eqNullSafe(F.col("in_memory_predicted_rate"))).alias("diff")).first()
    assert r.n == wf.ctx.validation.count() and r.diff == 0
