"""Model queries (spark.ml): not SQL-expressible, checked by row counts and invariants.

All run the engine's candidate parameters (``operators.models.PARAMETERS``).
"""

from __future__ import annotations


from ..functions.metrics import round_doubles
from ..operators.selection import CHECKS, STATED
from .catalog import register
from .workflow import workflow


@register("feature_screening")
def q_feature_screening(spark, sf):
    """7 feature sets x 2 families on the training-only inner split; set selection."""
    return round_doubles(workflow(spark, sf).screening)


@register("model_comparison")
def q_model_comparison(spark, sf):
    """Outer candidates + baselines on one holdout, ranked and selected."""
    return round_doubles(workflow(spark, sf).main_board)


def _clean(checks, label: str | None = None) -> str:
    """SQL of contract rows without violations."""
    head = f"'{label}' AS board, " if label else ""
    return " UNION ALL ".join(f"SELECT {head}'{c}' AS \"check\", CAST(0 AS BIGINT) AS violations" for c in checks)


_C21 = ["C21_duplicate_sets", "C21_set_mismatch", "C21_metrics_not_finite", "C21_score_not_family_mean", "C21_not_one_selected"]
_C20 = ["C20_pool_changed", "C20_bad_flags", "C20_metrics_not_finite", "C20_model_names_repeat", "C20_not_one_selected", "C20_selected_not_eligible",
        "C20_selected_not_minimum", "C20_other_model_selected", "C20_selection_identity_mismatch", "C20_feature_set_mismatch",
        "C20_selected_mae_mismatch", "C20_minimum_eligible_mae", "C20_eligible_models", "C20_mae_text"]
_C20_BASE = ["C20_baseline_eligible_or_selected", "C20_baseline_missing"]


@register("selection_contracts", _clean(["C16_holdout_rows_not_predicted", *CHECKS, *STATED, *_C21]))
def q_selection_contracts(spark, sf):
    """Candidate pool, truthful selection, baselines ineligible."""
    return workflow(spark, sf).main_contract()


@register("permutation_importance")
def q_permutation_importance(spark, sf):
    """Holdout MAE increase per shuffled feature of the selected model."""
    return round_doubles(workflow(spark, sf).importance())


@register("model_error_analysis")
def q_model_error_analysis(spark, sf):
    """A18 for the selected model: errors by six segment dimensions."""
    return round_doubles(workflow(spark, sf).error_analysis())


@register("temporal_stability")
def q_temporal_stability(spark, sf):
    """M9: rolling-origin refits of the selected candidate, one per stability month."""
    return round_doubles(workflow(spark, sf).stability())


@register("scenario_model_comparison")
def q_scenario_model_comparison(spark, sf):
    """Reduced-schema feature sets x 2 families for the scenario series."""
    return round_doubles(workflow(spark, sf).scenario_board)


@register("validation_predictions")
def q_validation_predictions(spark, sf):
    """Refit the selected model on all labeled rows and score the future table in template order."""
    return round_doubles(workflow(spark, sf).validation_predictions())


@register("scenario_predictions")
def q_scenario_predictions(spark, sf):
    """Score the reduced-schema scenario grid with the selected scenario model."""
    return round_doubles(workflow(spark, sf).scenario_predictions().orderBy("date"))


@register("streaming_scoring")
def q_streaming_scoring(spark, sf):
    """M12 on Structured Streaming: future rows arrive as files and are scored by the same fitted
    transform + model with trigger(availableNow); each row carries its batch prediction for parity."""
    from .. import constants as K
    from ..operators import features as FE
    from ..operators import models as M
    from ..sources.sinks import output_dir, write_table
    from ..streaming.scoring import run_available_now, score_stream
    from .context import context, fitted_state
    c = context(spark, sf)
    state = fitted_state(spark, sf, "development")
    cols = K.COMMON_FEATURE_SETS["basic_plus_route"]
    train = FE.transform(state, c.development, cols, keep=[K.TARGET])
    train = write_table(train, output_dir(spark, "features"))
    model = M.fit(train, cols, M.PARAMETERS["gbt_compact"], "stream_model", feature_set="basic_plus_route")
    src = output_dir(spark, "stream_source")
    c.validation.write.parquet(src)
    streamed = run_available_now(spark, src, c.validation.schema, state, model)
    batch = score_stream(c.validation, state, model).withColumnRenamed(K.PREDICTION, "batch_predicted_rate")
    return round_doubles(streamed.join(batch, "load_id", "full_outer"))


@register("run_summary")
def q_run_summary(spark, sf):
    """The nested run-summary row (split, selections, baselines, prediction summary)."""
    return workflow(spark, sf).run_summary()


@register("scenario_contracts", _clean(["C18_row_count", *[c for c in CHECKS if not c.startswith("C23")], *STATED]))
def q_scenario_contracts(spark, sf):
    """C18/C19 on the scenario leaderboard: pool, families, row count, truthful selection as stated."""
    return workflow(spark, sf).scenario_contract()


@register("scoring_contracts", _clean([
    "C11_columns", "C11_row_difference", "C11_id_null_or_duplicate", "C11_template_order_changed", "C13_id_set_mismatch", "C12_prediction_not_finite_positive",
    "C10_columns", "C10_fixed_inputs_changed", "C14_missing_days", "C14_extra_or_duplicate_days", "C10_prediction_not_finite_positive",
    "S6_bundle_differs", "S6_bundle_rows", "M12_stream_differs", "M12_stream_rows", "P17_residual_wrong", "P16_below_floor", "C16_holdout_rows"]))
def q_scoring_contracts(spark, sf):
    """C10-C14 on the models' own output, and parity of the reloaded bundle and of the stream with batch scoring."""
    return workflow(spark, sf).scoring_contract(lambda: q_streaming_scoring(spark, sf))


@register("summary_reconciliation", _clean([*_C20, *_C20_BASE], "main") + " UNION ALL " + _clean(_C20, "scenario"))
def q_summary_reconciliation(spark, sf):
    """Stored leaderboard and stored JSON run summary agree (after re-reading both)."""
    return workflow(spark, sf).reconcile()


@register("importance_top15")
def q_importance_top15(spark, sf):
    """The top-15 permutation importances (importance desc, feature asc) - a top-k report."""
    from ..operators.importance import top_importance
    return round_doubles(top_importance(workflow(spark, sf).importance(), 15))


@register("model_holdout_predictions")
def q_model_holdout_predictions(spark, sf):
    """Per-row holdout predictions of the selected model with residuals and segment keys."""
    return round_doubles(workflow(spark, sf).holdout_predictions().select(
        "load_id", "date", "actual", "predicted", "residual", "absolute_error", "distance_band", "route_status",
        "city_status"))


@register("inference_bundle")
def q_inference_bundle(spark, sf):
    """Save the final model and fitted state to the shared folder, reload, score; parity column."""
    return round_doubles(workflow(spark, sf).bundle_roundtrip())
