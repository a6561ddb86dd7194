"""The end-to-end model workflow (M4-M14) over the fixture, as memoised steps.

Order (leakage-safe, like the original run):
  inner split -> feature screening on training-only rows (7 sets x 2 families, M7)
  -> learned iteration count on the selected set (M4) -> outer candidates + baselines
  (M10) -> selection (O3) + contracts (C18/C19/C23) -> permutation importance (M8),
  error analysis (A18), temporal stability (M9) -> reduced-schema scenario selection
  (M11) -> refits on all labeled rows (M6) -> scoring of the future table (M12, J8)
  and of the scenario grid (M13).

Feature supersets are built once per split and written as Parquet to the shared checkpoint
folder (lineage cut, survives executor loss).  They are encoded once per split, and every candidate
takes its features from those vectors; boosted candidates of a split grow side by side.
The driver loops over candidates only - every fit and every score is a Spark job.

Steps that do not need each other run side by side: a boosted fit is a chain of short jobs that leaves
cores free.  A count that is learned is a prefix of the rounds, so its model grows all rounds while the
count is learned and is then cut to it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.metrics import regression_aggs
from ..once import once
from ..operators import features as FE
from ..operators import models as M
from ..operators.baselines import global_median, group_median_rpm
from ..operators.errors import holdout_errors, segment_errors
from ..operators.importance import permutation_importance
from ..operators.contracts import checks_table, one_row, prediction_contract, scenario_contract, union_checks
from ..operators.selection import (leaderboard, reconcile_summary, screening_contract, screening_table,
                                   selection_contract, stated_selection)
from ..sources.sinks import output_dir, write_document, write_table
from ..session import ensure_checkpoint_dir
from ..sources import fixture
from .context import FIXTURE_MIN_ROWS, context, fitted_state

SUPERSET = list(dict.fromkeys(sum(K.COMMON_FEATURE_SETS.values(), []) + sum(K.SCENARIO_FEATURE_SETS.values(), [])))
KEEP = ["load_id", "date", K.TARGET]
MAIN_POOL = ["gbt_compact", "gbt_smoother", "gbt_learned", "forest"]
BASELINES = ["global_median", "equipment_median_rpm"]
PATIENCE = 8
SCREEN_FAMILIES = {"gbt_compact": K.MODEL_FAMILY_A, "forest": K.MODEL_FAMILY_B}

# Independent fits run concurrently from the driver (like CrossValidator's parallelism):
# each fit is a sequence of small distributed jobs, so several keep the cluster busy.
# ``chronofit.fit_parallelism`` overrides; default = the context's parallelism, capped at 8.
PARALLELISM_KEY = "chronofit.fit_parallelism"
MAX_DEFAULT_PARALLELISM = 8

_RUNS: dict[tuple, "Workflow"] = {}


#: A forest's jobs fill the cores, so few forests grow at a time: the short jobs of boosted rounds wait for those before them.
FORESTS = 2


def _workers() -> int:
    spark = SparkSession.active()
    default = min(MAX_DEFAULT_PARALLELISM, max(1, spark.sparkContext.defaultParallelism))
    return max(1, int(spark.conf.get(PARALLELISM_KEY, str(default))))


def _parallel(fn, items, workers: int | None = None):
    with ThreadPoolExecutor(max_workers=workers or _workers()) as pool:
        return list(pool.map(fn, items))


def _side_by_side(*steps):
    """What the functions return; each has a thread of its own, as one may wait for a step of another."""
    return _parallel(lambda step: step(), steps, len(steps))


def _fit_all(rows: M.Prepared, candidates: list[tuple]) -> dict[str, M.RateModel]:
    """The candidates by name: the boosted ones side by side, beside them a few of the others at a time."""
    together = [c for c in candidates if c[3]["family"] == K.MODEL_FAMILY_A]
    others = [c for c in candidates if c[3]["family"] != K.MODEL_FAMILY_A]
    boosted, single = _side_by_side(lambda: M.fit_prepared(rows, together) if together else [],
                                    lambda: _parallel(lambda c: M.fit_prepared(rows, [c])[0], others, min(FORESTS, _workers())))
    found = {m.name: m for m in [*boosted, *single]}
    return {name: found[name] for name, *_ in candidates}


def _cut(model: M.RateModel, rounds: int) -> None:
    """``model``, grown for all rounds, as if fitted for the learned number of them."""
    model.learner, model.best_iteration = model.learner.first(rounds), rounds
    model.params["maxIter"] = rounds


def workflow(spark: SparkSession, sf_dir: str) -> "Workflow":
    key = (id(spark), sf_dir.rstrip("/"))
    if key not in _RUNS:
        _RUNS[key] = Workflow(spark, sf_dir)
    return _RUNS[key]


class Workflow:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir
        self.params = M.PARAMETERS
        self.ctx = context(spark, sf_dir, FIXTURE_MIN_ROWS)
        ensure_checkpoint_dir(spark)

    def _ahead(self, *names: str) -> None:
        """Runs the named steps side by side."""
        _side_by_side(*[lambda name=name: getattr(self, name) for name in names])

    # -- feature supersets ------------------------------------------------
    def _feats(self, state_on: str, rows: DataFrame) -> DataFrame:
        st = fitted_state(self.spark, self.sf, state_on)
        return write_table(FE.transform(st, rows, SUPERSET, keep=KEEP), output_dir(self.spark, "features"))

    @once
    def inner_train(self):
        return self._feats("inner_training", self.ctx.inner_training)

    @once
    def inner_valid(self):
        return self._feats("inner_training", self.ctx.inner_validation)

    @once
    def outer_train(self):
        return self._feats("training", self.ctx.training)

    @once
    def outer_holdout(self):
        return self._feats("training", self.ctx.holdout)

    @once
    def inner_rows(self) -> M.Prepared:
        return M.prepare(self.inner_train, SUPERSET)

    @once
    def outer_rows(self) -> M.Prepared:
        return M.prepare(self.outer_train, SUPERSET)

    # -- M7 screening -----------------------------------------------------
    @once
    def screening_long(self) -> DataFrame:
        jobs = [(fs, name, fam) for fs in sorted(K.COMMON_FEATURE_SETS) for name, fam in SCREEN_FAMILIES.items()]
        self._ahead("inner_rows", "inner_valid")
        fitted = _fit_all(self.inner_rows, [(f"{name}__{fs}", fs, K.COMMON_FEATURE_SETS[fs], self.params[name]) for fs, name, _ in jobs])

        def one(job):
            fs, name, fam = job
            m = fitted[f"{name}__{fs}"]
            if fam == K.MODEL_FAMILY_A:  # the learned count is a prefix of the rounds, so nothing is fitted again
                curve = [r["error"] for r in sorted(M.staged_errors(m, self.inner_valid).collect(), key=lambda r: r["iteration"])]
                m.best_iteration = M.best_of_curve(curve, PATIENCE)
                m.learner = m.learner.first(m.best_iteration)
            p = M.predict(m, self.inner_valid)
            return p.select(F.lit(fs).alias("feature_set"), F.lit(fam).alias("model_family"), F.lit(m.name).alias("model"),
                            F.lit(m.best_iteration).cast("int").alias("best_iteration"), F.col(K.TARGET).alias("actual"), "predicted")
        return write_table(_union(_parallel(one, jobs)), output_dir(self.spark, "screening"))

    @once
    def screening(self) -> DataFrame:
        board = self.screening_long.groupBy("feature_set", "model_family", "best_iteration").agg(
            *regression_aggs("actual", "predicted", with_bias=False))
        table = screening_table(board, families=sorted(SCREEN_FAMILIES.values()))
        counts = {fs: len(c) for fs, c in K.COMMON_FEATURE_SETS.items()}
        fc = self.spark.createDataFrame(sorted(counts.items()), "feature_set string, feature_count int")
        return table.join(F.broadcast(fc), "feature_set").withColumn(
            "evaluation_scope", F.lit("training_only_inner_chronological"))

    @once
    def selected_set(self) -> str:
        return self.screening.where("selected_for_outer_comparison").select("feature_set").first()[0]

    # -- M4 learned iterations --------------------------------------------
    def learned(self, wanted: list[tuple[list, str]]) -> list[int]:
        """The counts for several (list of features, parameters' name)."""
        asked = [(features, {"patience": PATIENCE} | self.params[name]) for features, name in wanted]
        return M.learn_prepared(self.inner_rows, self.inner_train, self.inner_valid, asked)

    # -- M10 main comparison ----------------------------------------------
    @once
    def candidates(self) -> dict[str, M.RateModel]:
        self._ahead("selected_set", "outer_rows", "outer_holdout")
        cols = K.COMMON_FEATURE_SETS[self.selected_set]
        pool = {name: dict(self.params[name]) for name in MAIN_POOL}
        pool["gbt_learned"].pop("patience", None)
        fitted, (best,) = _side_by_side(
            lambda: _fit_all(self.outer_rows, [(name, self.selected_set, cols, params) for name, params in pool.items()]),
            lambda: self.learned([(cols, "gbt_learned")]))
        _cut(fitted["gbt_learned"], best)
        return fitted

    @once
    def main_long(self) -> DataFrame:
        parts = []
        for name, m in self.candidates.items():
            p = M.predict(m, self.outer_holdout)
            parts.append(_long_rows(p, name, m.family, m.feature_set, m.parameters_text, m.best_iteration, True))
        tr, ho = self.ctx.training, self.ctx.holdout
        g = global_median(tr, ho)
        e = group_median_rpm(tr, ho)
        parts.append(_long_rows(g, "global_median", K.BASELINE_FAMILY, "target_only", "{}", None, False))
        parts.append(_long_rows(e, "equipment_median_rpm", K.BASELINE_FAMILY, "distance + equipment", "{}", None,
                                False))
        return write_table(_union(parts), output_dir(self.spark, "predictions"))

    @once
    def main_board(self) -> DataFrame:
        return leaderboard(self.main_long).cache()

    @once
    def selected(self) -> M.RateModel:
        name = self.main_board.where("selected").select("model").first()[0]
        return self.candidates[name]

    def main_contract(self) -> DataFrame:
        """C18/C19/C23 on the main leaderboard and C21 on the screening table."""
        expected = {n: m.family for n, m in self.candidates.items()}
        n_hold = self.ctx.holdout.agg(F.count(F.lit(1))).scalar()
        per_model = self.main_long.groupBy("model").agg(F.count(F.lit(1)).alias("n"),
                                                        F.count_if(F.col("predicted").isNull()).alias("miss"))
        unpredicted = per_model.agg(F.coalesce(F.sum(F.abs(F.col("n") - n_hold) + F.col("miss")), F.lit(0))).scalar()
        return union_checks([
            checks_table(self.spark, {"C16_holdout_rows_not_predicted": unpredicted}),
            selection_contract(self.main_board, expected=expected, baselines=BASELINES, stated=stated_selection(self.main_board)),
            screening_contract(self.screening, sorted(K.COMMON_FEATURE_SETS), sorted(SCREEN_FAMILIES.values())),
        ])

    def scenario_contract(self) -> DataFrame:
        """C18/C19 on the scenario leaderboard: pool, families, rows, truthful selection."""
        expected = {n: m.family for n, m in self.scenario_candidates.items()}
        checks = selection_contract(self.scenario_board, expected=expected, stated=stated_selection(self.scenario_board))
        n = self.scenario_board.agg(F.abs(F.count(F.lit(1)) - len(expected))).scalar()
        return union_checks([checks_table(self.spark, {"C18_row_count": n}), checks])

    def scoring_contract(self, stream) -> DataFrame:
        """C10-C14 on the models' output; parity of the saved bundle and of the stream (that ``stream()`` scores) with batch;
        P16, P17 on the holdout."""
        streamed, *_ = _side_by_side(stream, lambda: self.final_model, lambda: self.scenario_model)
        out = write_table(self.validation_predictions(), output_dir(self.spark, "validation_predictions"))
        expected = fixture.scenario_inputs(self.spark, self.sf).first().asDict()   # one row
        expected["month"] = str(expected["month"])

        def parity(df, a, b):
            return one_row(df.agg(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias("differs"), F.count(F.lit(1)).alias("rows")))
        n = self.ctx.validation.agg(F.count(F.lit(1))).scalar()
        bundle = parity(write_table(self.bundle_roundtrip(), output_dir(self.spark, "bundle_scores")), K.PREDICTION, "in_memory_predicted_rate")
        stream = parity(streamed, K.PREDICTION, f"batch_{K.PREDICTION}")
        hold = one_row(write_table(self.holdout_predictions(), output_dir(self.spark, "holdout_predictions")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted") < 1).alias("low"),
            F.count_if(~F.coalesce(F.col("residual") == F.col("predicted") - F.col("actual"), F.lit(False))).alias("wrong")))
        n_hold = self.ctx.holdout.agg(F.count(F.lit(1))).scalar()
        return union_checks([
            prediction_contract(out, fixture.template(self.spark, self.sf), self.ctx.validation),
            scenario_contract(self.scenario_predictions(), expected),
            checks_table(self.spark, {
                "S6_bundle_differs": bundle.getField("differs"), "S6_bundle_rows": F.abs(bundle.getField("rows") - n),
                "M12_stream_differs": stream.getField("differs"), "M12_stream_rows": F.abs(stream.getField("rows") - n),
                "P17_residual_wrong": hold.getField("wrong"), "P16_below_floor": hold.getField("low"),
                "C16_holdout_rows": F.abs(hold.getField("rows") - n_hold)})])

    # -- S8 run summary, C20 reconciliation ------------------------------------
    def run_summary(self) -> DataFrame:
        """One nested row - split, selections, baseline metrics, prediction summary."""
        self._ahead("final_model", "scenario_board")

        def pick(board):
            return board.where("selected").select(F.struct(
                "model", F.col("model_family").alias("family"), "feature_set", "mae",
                F.col("mae").cast("string").alias("mae_text"), "signature",
                board.where("eligible").agg(F.min("mae")).scalar().alias("minimum_eligible_mae"),
                board.where("eligible").agg(F.array_sort(F.collect_set("model"))).scalar().alias("eligible_models")).alias("s")).scalar()
        b = self.main_board
        base = b.where(F.col("model").isin(*BASELINES)).agg(F.map_from_entries(F.collect_list(F.struct(
            "model", F.struct("mae", "rmse", "r2", "smape")))).alias("m")).scalar()
        pred = self.validation_predictions().agg(
            F.struct(F.count(F.lit(1)).alias("rows"), F.min(K.PREDICTION).alias("min"),
                     F.avg(K.PREDICTION).alias("mean"), F.max(K.PREDICTION).alias("max")).alias("p")).scalar()
        o = self.ctx.outer
        return self.spark.range(1).select(
            F.struct(F.lit(str(o.cutoff)).cast("date").alias("cutoff"), F.lit(o.horizon_days).alias("horizon_days"),
                     F.lit(self.ctx.inner.horizon_days).alias("inner_horizon_days")).alias("split"),
            F.lit(self.selected_set).alias("selected_feature_set"),
            pick(self.main_board).alias("selection"), pick(self.scenario_board).alias("scenario_selection"),
            base.alias("baseline_metrics"), pred.alias("validation_prediction_summary"))

    def reconcile(self) -> DataFrame:
        """C20: write both leaderboards and the run summary, re-read them, reconcile them."""
        self._ahead("final_model", "scenario_board")
        folder = output_dir(self.spark, "run")
        main = write_table(self.main_board, f"{folder}/model_comparison")
        scenario = write_table(self.scenario_board, f"{folder}/scenario_model_comparison")
        write_document(self.run_summary(), f"{folder}/run_summary")
        summary = self.spark.read.json(f"{folder}/run_summary")
        a = reconcile_summary(main, summary, {n: m.family for n, m in self.candidates.items()}, BASELINES)
        b = reconcile_summary(scenario, summary, {n: m.family for n, m in self.scenario_candidates.items()}, [], field="scenario_selection")
        return union_checks([a.select(F.lit("main").alias("board"), "check", "violations"), b.select(F.lit("scenario").alias("board"), "check", "violations")])

    # -- diagnostics --------------------------------------------------------
    def importance(self) -> DataFrame:
        return permutation_importance(self.selected, self.outer_holdout)

    def holdout_predictions(self) -> DataFrame:
        """The selected model's holdout rows with residuals and segment keys."""
        pred = M.predict(self.selected, self.outer_holdout).select("load_id", "predicted")
        return holdout_errors(self.ctx.holdout.join(pred, "load_id"), self.ctx.training)

    def error_analysis(self) -> DataFrame:
        """A18 for the selected model: six segment dimensions in one grouping-sets pass."""
        return segment_errors(self.holdout_predictions())

    def stability(self) -> DataFrame:
        """M9: per fold, refit the feature state and the selected candidate on earlier months."""
        sel = self.selected
        params = dict(sel.params)
        def one(f):
            dev = self.ctx.development
            st = fitted_state(self.spark, self.sf, f.name)
            # Fitting scans its input several times: cut the lineage once.
            trf = write_table(FE.transform(st, dev.where(F.col("date") < F.lit(f.before)), sel.features, keep=[K.TARGET]), output_dir(self.spark, "features"))
            hof = FE.transform(st, dev.where(F.col("date").between(F.lit(f.start), F.lit(f.end))), sel.features, keep=[K.TARGET])
            m = M.fit(trf, sel.features, params, sel.name, feature_set=sel.feature_set)
            p = M.predict(m, hof)
            return p.select(F.lit(f.name).alias("holdout_month"), F.col(K.TARGET).alias("actual"),
                            "predicted").withColumn("training_rows", trf.agg(F.count(F.lit(1))).scalar())
        allp = _union(_parallel(one, self.ctx.folds))
        return allp.groupBy("holdout_month", "training_rows").agg(
            *regression_aggs("actual", "predicted", with_bias=False)).select(
            "holdout_month", F.lit("post_selection_temporal_diagnostic").alias("evaluation_role"),
            F.lit(sel.name).alias("model"), F.lit(sel.family).alias("model_family"),
            F.lit(sel.feature_set).alias("feature_set"), "training_rows", F.col("rows").alias("holdout_rows"),
            "mae", "rmse", "r2", "smape")

    # -- M11 scenario selection -----------------------------------------------
    @once
    def scenario_candidates(self) -> dict[str, M.RateModel]:
        jobs = [(f"scenario_{'gbt' if fam == K.MODEL_FAMILY_A else 'forest'}__{fs}", fs, base)
                for fs in sorted(K.SCENARIO_FEATURE_SETS) for base, fam in SCREEN_FAMILIES.items()]
        boosted = [(name, fs, base) for name, fs, base in jobs if SCREEN_FAMILIES[base] == K.MODEL_FAMILY_A]
        self._ahead("inner_rows", "inner_valid", "outer_rows", "outer_holdout")
        fitted, counts = _side_by_side(
            lambda: _fit_all(self.outer_rows, [(name, fs, K.SCENARIO_FEATURE_SETS[fs], dict(self.params[base])) for name, fs, base in jobs]),
            lambda: self.learned([(K.SCENARIO_FEATURE_SETS[fs], base) for _, fs, base in boosted]))
        for (name, *_), n in zip(boosted, counts):
            _cut(fitted[name], n)
        return fitted

    @once
    def scenario_board(self) -> DataFrame:
        parts = []
        for name, m in self.scenario_candidates.items():
            p = M.predict(m, self.outer_holdout)
            parts.append(_long_rows(p, name, m.family, m.feature_set, m.parameters_text, m.best_iteration, True))
        board = leaderboard(write_table(_union(parts), output_dir(self.spark, "scenario_predictions")), label="scenario")
        counts = {fs: len(c) for fs, c in K.SCENARIO_FEATURE_SETS.items()}
        fc = self.spark.createDataFrame(sorted(counts.items()), "feature_set string, feature_count int")
        return board.join(F.broadcast(fc), "feature_set").cache()

    # -- M6 refits + M12 / M13 scoring ------------------------------------------
    def _refit(self, sel: M.RateModel) -> tuple[M.RateModel, object]:
        st = fitted_state(self.spark, self.sf, "development")
        trf = write_table(FE.transform(st, self.ctx.development, sel.features, keep=[K.TARGET]), output_dir(self.spark, "features"))
        return M.fit(trf, sel.features, dict(sel.params), sel.name, feature_set=sel.feature_set), st

    @once
    def final_model(self):
        return self._refit(self.selected)

    @once
    def scenario_model(self):
        return self._refit(self.scenario_candidates[self.scenario_board.where("selected").select("model").first()[0]])

    def validation_predictions(self) -> DataFrame:
        model, st = self.final_model
        feats = FE.transform(st, self.ctx.validation, model.features, keep=["load_id"])
        pred = M.predict(model, feats, K.PREDICTION).select("load_id", K.PREDICTION)
        tmpl = fixture.template(self.spark, self.sf).select("load_id", "ordinal")
        return tmpl.join(pred, "load_id", "left").select("load_id", K.PREDICTION, "ordinal")

    def bundle_roundtrip(self) -> DataFrame:
        """Save the refitted model + feature state, load both back, score the future table.

        Rows carry the reloaded bundle's prediction and the in-memory one (parity check)."""
        model, st = self.final_model
        folder = output_dir(self.spark, "inference_bundle")
        model.save(f"{folder}/model", self.spark)
        st.save(f"{folder}/state")
        model2 = M.RateModel.load(self.spark, f"{folder}/model")
        st2 = FE.FeatureState.load(self.spark, f"{folder}/state")
        val = self.ctx.validation
        again = M.predict(model2, FE.transform(st2, val, model2.features, keep=["load_id"]), K.PREDICTION)
        live = M.predict(model, FE.transform(st, val, model.features, keep=["load_id"]), "in_memory_predicted_rate")
        return again.select("load_id", K.PREDICTION).join(live.select("load_id", "in_memory_predicted_rate"),
                                                          "load_id", "full_outer")

    def scenario_predictions(self) -> DataFrame:
        model, st = self.scenario_model
        grid = fixture.scenario(self.spark, self.sf)
        feats = FE.transform(st, grid, model.features, keep=K.SCENARIO_COLUMNS)
        scored = M.predict(model, feats, K.PREDICTION)
        return grid.join(scored.select("date", K.PREDICTION), "date").select(*K.SCENARIO_COLUMNS, K.PREDICTION)


def _long_rows(p: DataFrame, model: str, family: str, fs: str, params: str, best, eligible: bool) -> DataFrame:
    return p.select(F.lit(model).alias("model"), F.lit(family).alias("model_family"), F.lit(fs).alias("feature_set"),
                    F.lit(params).alias("parameters"), F.lit(best).cast("int").alias("best_iteration"),
                    F.lit(eligible).alias("eligible"), "load_id", F.col(K.TARGET).cast("double").alias("actual"),
                    F.col("predicted").cast("double").alias("predicted"))


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
