"""Ensembles for absolute error and ordinal codes against plain Python."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chronofit.operators import encoding as EN
from chronofit.operators import ensembles as E
from chronofit.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    dice = np.random.default_rng(3)
    x = dice.uniform(0, 10, (400, 2))
    y = np.where(x[:, 0] > 5, 3.0, 1.0) + 0.2 * x[:, 1] + dice.standard_normal(400) * 0.1
    y[::17] += 40  # outliers, which absolute error shrugs off
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y.tolist())], ["__x", "y"]).repartition(3).checkpoint()


PARAMS = {"maxIter": 9, "stepSize": 0.5, "maxDepth": 2, "minInstancesPerNode": 5}


def low_median(values):
    return sorted(values)[(len(values) - 1) // 2]


def test_leaf_values_are_medians_of_residuals(rows):
    model = E.AbsoluteBoost.fit(rows, "y", PARAMS, 42)
    got = model._leaves(rows).collect()
    y = np.array([r.y for r in got])
    now = np.full(len(y), low_median(y))
    assert model.base == now[0] and len(model.trees) == 9
    for k, values in enumerate(model.values):
        leaf = np.array([int(r[f"__leaf{k}"]) for r in got])
        assert set(leaf) == set(range(len(values)))
        for i, v in enumerate(values):
            assert v == pytest.approx(low_median((y - now)[leaf == i].tolist()), abs=1e-12)
        now = now + 0.5 * np.array(values)[leaf]
    scored = sorted(r.p for r in model.score(rows, "p").collect())
    assert np.allclose(scored, np.sort(now), atol=1e-12)


def test_absolute_loss_is_lower_than_squared_loss_with_outliers(rows):
    absolute = E.AbsoluteBoost.fit(rows, "y", PARAMS, 42).score(rows, "p")
    squared = E.SparkEnsemble.fit(rows, "y", PARAMS, 42).score(rows, "p")
    a, s = (df.agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0] for df in (absolute, squared))
    assert a < s


def test_staged_predictions_are_those_of_shorter_models(rows):
    model = E.AbsoluteBoost.fit(rows, "y", PARAMS, 42)
    staged = model.staged(rows, "all")
    for n in (1, 4, 9):
        both = model.first(n).score(staged, "p").select("p", F.element_at("all", n).alias("q")).collect()
        assert all(r.p == pytest.approx(r.q, abs=1e-12) for r in both)


def test_forest_predicts_the_median_of_its_leaves(spark, rows, tmp_path):
    model = E.QuantileForest.fit(rows, "y", {"numTrees": 3, "maxDepth": 2, "minInstancesPerNode": 20}, 42)
    leaves = model.forest.transform(rows).select("y", "__leaf").collect()
    held = {}
    for r in leaves:
        for tree, leaf in enumerate(r["__leaf"]):
            held.setdefault((tree, int(leaf)), []).append(r.y)
    def quantiles(v):
        v = sorted(v)
        return [v[max(0, int(np.ceil((i + 0.5) / E.LEAF_QUANTILES * len(v))) - 1)] for i in range(E.LEAF_QUANTILES)]
    q = {k: quantiles(v) for k, v in held.items()}
    got = model.score(rows, "p").withColumn("leaf", F.lit(0)).select("y", "p").collect()
    want = []
    for r in leaves:
        pooled = sorted(v for tree, leaf in enumerate(r["__leaf"]) for v in q[tree, int(leaf)])
        want.append((r.y, (pooled[(len(pooled) - 1) // 2] + pooled[len(pooled) // 2]) / 2))
    assert np.allclose(sorted(map(tuple, got)), sorted(want))
    model.save(str(tmp_path), spark)
    again = E.QuantileForest.load(str(tmp_path), spark).score(rows, "p").select("y", "p").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_boost_round_trip_and_empty_input(spark, rows, tmp_path):
    model = E.AbsoluteBoost.fit(rows, "y", PARAMS, 42)
    model.save(str(tmp_path), spark)
    again = E.AbsoluteBoost.load(str(tmp_path), spark)
    assert (again.base, again.step, again.values) == (model.base, model.step, model.values)
    a, b = (sorted(r.p for r in m.score(rows, "p").collect()) for m in (model, again))
    assert a == b
    assert E.AbsoluteBoost.fit(rows.where("y > 1e9"), "y", PARAMS, 42).trees == []


def test_codes_are_dense_ranks_and_unknown_is_minus_one(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("b", "é"), ("c", "x"), ("Ab", "z")], "p string, q string")
    codes = EN.fit_codes(train, ["p", "q"])
    assert sorted(tuple(r) for r in codes.collect()) == [("p", "Ab", 0), ("p", "a", 1), ("p", "b", 2), ("p", "c", 3), ("q", "x", 0), ("q", "z", 1), ("q", "é", 2)]
    new = spark.createDataFrame([("c", "q"), (None, "z"), ("zz", None)], "p string, q string")
    for limit in ("10", "0"):  # broadcast, and joined by shuffling
        spark.conf.set("chronofit.broadcast_rows", limit)
        got = EN.encode(new, codes, ["p", "q"], codes.count()).select("__ix_p", "__ix_q").collect()
        assert sorted(tuple(r) for r in got) == [(-1.0, -1.0), (-1.0, 1.0), (3.0, -1.0)]
    spark.conf.unset("chronofit.broadcast_rows")


def test_missing_numerics_take_the_exact_training_median(spark):
    train = spark.createDataFrame([(1.0, "a"), (None, "a"), (4.0, "b"), (9.0, "b"), (float("nan"), "c"), (20.0, "c")], "weight double, equipment string")
    encoder = EN.Encoder.fit(train, ["equipment"], ["weight"])
    assert encoder.fills == {"weight": 6.5}
    got = encoder.vectors(spark.createDataFrame([(None, "b"), (float("nan"), "x"), (3.0, None)], "weight double, equipment string"),
                          ["weight", "equipment"], ["equipment"]).select("__x").collect()
    assert sorted(tuple(r["__x"]) for r in got) == [(3.0, -1.0), (6.5, -1.0), (6.5, 1.0)]


def test_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "distance double, posted_rate double")
    for features in (["distance", "posted_rate"], ["distance", "load_id"], ["posted_rate"], ["weight"]):  # C15
        with pytest.raises(ValueError):
            M.fit(df, features, M.PARAMETERS["forest"])
    with pytest.raises(ValueError):  # C25
        M.learn_iterations(df, df.withColumn("distance", F.lit(1)), ["distance"], M.PARAMETERS["gbt_learned"])
    with pytest.raises(ValueError):
        M.learn_iterations(df, df, ["distance"], M.PARAMETERS["forest"])


def test_best_of_curve():
    assert M.best_of_curve([5, 4, 3, 3.5, 3.2, 1], 2) == 3
    assert M.best_of_curve([5, 4, 3, 3.5, 3.2, 1], 3) == 6
    assert M.best_of_curve([1.0], 3) == 1


def test_first_tree_is_that_of_spark_ml_and_nothing_stays_held(spark, rows):
    from pyspark.ml.regression import DecisionTreeRegressor
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = E.AbsoluteBoost.fit(rows, "y", PARAMS, 42)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    signs = rows.withColumn("s", F.signum(F.col("y") - model.base))
    tree = DecisionTreeRegressor(featuresCol="__x", labelCol="s", predictionCol="m", leafCol="l", maxDepth=2, minInstancesPerNode=5).fit(signs)
    pairs = model.first(1)._leaves(tree.transform(signs)).select("l", "__leaf0").distinct().collect()
    assert len(pairs) == len({r.l for r in pairs}) == len({r["__leaf0"] for r in pairs}) > 2
    nodes = [(j, c) for j, c in zip(model.trees[0].feature, model.trees[0].cut) if j >= 0]
    assert len(nodes) == len(pairs) - 1 and all(f"feature {j} <= {c}" in tree.toDebugString for j, c in nodes)


def test_models_grown_side_by_side_are_those_grown_alone_in_the_passes_of_one(spark, rows):
    from pyspark.ml.feature import VectorSlicer
    sc, asked = spark.sparkContext, [([0, 1], PARAMS), ([1], PARAMS | {"maxIter": 3, "maxDepth": 1}), ([1, 0], PARAMS | {"stepSize": 0.3})]

    def jobs(name, fn):
        sc.setJobGroup(name, name)
        found = fn()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return found, len(sc.statusTracker().getJobIdsForGroup(name))
    blocks = E.Blocks.of(rows, "y", 42)
    together, many = jobs("together", lambda: E.AbsoluteBoost.fit_many(blocks, asked))
    _, one = jobs("one", lambda: E.AbsoluteBoost.fit_many(blocks, asked[:1]))
    assert many < 1.5 * one
    for model, (places, params) in zip(together, asked):
        data = VectorSlicer(inputCol="__x", outputCol="s", indices=places).transform(rows).select(F.col("s").alias("__x"), "y")
        alone = E.AbsoluteBoost.fit(data, "y", params, 42)
        assert (model.base, model.step, model.trees, model.values) == (alone.base, alone.step, alone.trees, alone.values)


def test_candidates_on_prepared_rows_are_those_fitted_alone(spark):
    dice = np.random.default_rng(5)
    table = [(float(d), None if d < 2 else float(w), str(e), float(d * (2 + w / 10 + (e == "b")))) for d, w, e in zip(
        dice.uniform(1, 9, 300), dice.uniform(0, 10, 300), dice.choice(["a", "b", "c"], 300))] + [(None, 1.0, "a", 5.0), (3.0, 1.0, "a", None)]
    feats = spark.createDataFrame(table, "distance double, weight double, equipment string, posted_rate double").repartition(2).checkpoint()
    wide, small = ["distance", "weight", "equipment"], ["equipment", "distance"]
    boost, forest = M.PARAMETERS["gbt_compact"] | {"maxIter": 3}, M.PARAMETERS["forest"] | {"numTrees": 2}
    got = M.fit_prepared(M.prepare(feats, wide), [("a", "s", wide, boost), ("b", "s", small, forest), ("c", "t", small, boost)])
    assert [(m.name, m.feature_set, m.features) for m in got] == [("a", "s", wide), ("b", "s", small), ("c", "t", small)]
    for m in got:
        alone = M.fit(feats, m.features, m.params)
        both = M.predict(alone, M.predict(m, feats, "p"), "q").select("p", "q").collect()
        assert len(both) == 302 and all(r.p == r.q for r in both)
    with pytest.raises(ValueError):
        M.fit_prepared(M.prepare(feats, wide), [("a", "s", ["weight"], boost)])
