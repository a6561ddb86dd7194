"""What the models' time and disk rest on: values counted in few passes, steps run once, rows encoded once."""

import threading
import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chronofit import constants as K
from chronofit.operators import ensembles as E
from chronofit.operators import features as FE
from chronofit.operators import importance as I
from chronofit.operators import models as M


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    dice = np.random.default_rng(8)
    x = dice.uniform(0, 10, (900, 3))
    y = np.where(x[:, 0] > 5, 3.0, 1.0) + 0.2 * x[:, 1] + dice.standard_normal(900)
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["__x", "y"]).repartition(3).checkpoint()


def test_ranked_values_are_exact_whatever_is_sent_first(spark, monkeypatch):
    dice = np.random.default_rng(4)
    groups, values = dice.integers(0, 3, 5000), np.round(dice.standard_normal(5000), 2)   # many equal values
    table = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, values)], "g int, v double").repartition(4).checkpoint()

    def sets(batch):
        g, v = (c.to_numpy() for c in batch.columns)
        yield [(0, (g.astype(np.int8), v)), (7, (np.zeros(len(g), dtype=np.int8), -v))]
    probs = [0.1, 0.5, 1.0]
    want = {(0, g): values[groups == g] for g in range(3)} | {(7, 0): -values}
    want = {k: [np.sort(v)[int(np.ceil(p * len(v))) - 1] for p in probs] for k, v in want.items()}
    for points, chunk in ((5, 1 << 21), (5, 300), (10_000, 300)):
        monkeypatch.setattr(E, "CHUNK_ROWS", chunk)
        assert E.exact_ranked(table, sets, probs, points) == want


def test_leaf_medians_and_quantiles_need_no_row_per_value(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "MEDIAN_POINTS", 4)
    monkeypatch.setattr(E, "LEAF_POINTS", 40)
    sent, real = [], E._merged
    monkeypatch.setattr(E, "_merged", lambda parts, *a: (sent.append(parts.count()), real(parts, *a))[1])
    params = {"maxIter": 3, "stepSize": 0.5, "maxDepth": 2, "minInstancesPerNode": 5}
    model = E.AbsoluteBoost.fit(rows, "y", params, 42)
    now = np.full(900, model.base)
    got = model._leaves(rows).collect()
    y = np.array([r.y for r in got])
    for k, values in enumerate(model.values):
        leaf = np.array([r[f"__leaf{k}"] for r in got])
        assert values == pytest.approx([np.sort((y - now)[leaf == i])[((leaf == i).sum() - 1) // 2] for i in range(len(values))], abs=1e-12)
        now = now + 0.5 * np.array(values)[leaf]
    forest = E.QuantileForest.fit(rows, "y", {"numTrees": 2, "maxDepth": 2, "minInstancesPerNode": 20}, 42)
    assert max(sent) <= 3 * 8 * E.LEAF_QUANTILES                 # far from 900 rows of 2 trees, or of 3 rounds
    held = {}
    for r in forest.forest.transform(rows).select("y", "__leaf").collect():
        for tree, leaf in enumerate(r["__leaf"]):
            held.setdefault((tree, int(leaf)), []).append(r.y)
    for (tree, leaf), v in held.items():
        assert forest.held[tree][leaf] == [sorted(v)[int(np.ceil((i + 0.5) / E.LEAF_QUANTILES * len(v))) - 1] for i in range(E.LEAF_QUANTILES)]
    plan = _plan(forest.score(rows, "p").select("p"))
    assert "array_sort" not in plan and "Join" not in plan


def test_predictions_brought_forward_and_small_files_change_no_model(rows, monkeypatch):
    params = {"maxIter": 5, "stepSize": 0.5, "maxDepth": 2, "minInstancesPerNode": 5}
    blocks = E.Blocks.of(rows, "y", 42)
    asked = [([0, 1, 2], params), ([1, 0], params | {"maxIter": 3})]
    want = E.AbsoluteBoost.fit_many(blocks, asked)
    monkeypatch.setattr(E, "CUT_ROUNDS", 2)
    assert E.AbsoluteBoost.fit_many(blocks, asked) == want
    assert len(blocks.table.inputFiles()) > 1 and all(f.endswith(".zstd.parquet") for f in blocks.table.inputFiles())


def test_a_step_asked_for_by_many_threads_runs_once():
    from chronofit.once import once
    from chronofit.plans.workflow import Workflow, _side_by_side
    ran = []

    class Steps:
        @once
        def step(self):
            ran.append(threading.get_ident())
            time.sleep(0.2)
            return len(ran)
    steps = Steps()
    assert _side_by_side(*[lambda: steps.step] * 6) == [1] * 6 and len(ran) == 1
    assert isinstance(Workflow.inner_valid, once) and isinstance(M.Prepared.blocks, once)


def test_importance_from_vectors_is_that_of_moved_columns(spark):
    dice = np.random.default_rng(2)
    table = [(float(d), None if d < 2 else float(w), str(e), float(d * (2 + w / 10 + (e == "b")))) for d, w, e in zip(
        dice.uniform(1, 9, 300), dice.uniform(0, 10, 300), dice.choice(["a", "b", "c"], 300))] + [(None, 1.0, "a", 5.0), (3.0, 1.0, None, None)]
    feats = spark.createDataFrame(table, "distance double, weight double, equipment string, posted_rate double").repartition(2).checkpoint()
    cols = ["distance", "weight", "equipment"]
    model = M.fit(feats, cols, M.PARAMETERS["gbt_compact"] | {"maxIter": 4})
    out = I.permutation_importance(model, feats)
    assert "CASE WHEN (__feature" not in _plan(out)

    class Plain:
        def __init__(self, learner):
            self.score = learner.score
    plain = M.RateModel(model.name, model.family, model.params, model.features, model.encoder, Plain(model.learner))
    got, want = ({r.feature: tuple(r)[1:] for r in o.collect()} for o in (out, I.permutation_importance(plain, feats)))
    assert set(got) == set(want) == set(cols) and all(got[f] == pytest.approx(want[f], abs=1e-9) for f in cols)


def test_a_batch_names_its_texts_once_and_the_rows_of_a_state_are_narrow(spark, monkeypatch):
    from conftest import SF_SMALL
    from chronofit.plans.context import context, fitted_state
    c = context(spark, SF_SMALL)
    st = fitted_state(spark, SF_SMALL)
    assert "regexp_replace" not in _plan(FE.transform(st, c.holdout, ["route_frequency"], keep=["load_id"]))
    stored, real = {}, FE.stored_table
    monkeypatch.setattr(FE, "stored_table", lambda t, n: (stored.setdefault(n, t.columns), real(t, n))[1])
    FE.fit(c.inner_training)
    assert "load_id" not in stored["clean_rows"] and K.TARGET not in stored["clean_rows"]
