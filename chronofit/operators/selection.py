"""Leaderboards and model selection.

A leaderboard is computed in Spark from a LONG prediction table
``(scope..., model, model_family, feature_set, eligible, actual, predicted)`` - one
aggregate for every candidate of every scope (fold, segment, scenario) at once.
Selection = lowest finite MAE among eligible rows, exact ties broken by model name
(``row_number`` over a per-scope window; a scope holds a handful of candidates).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import parse_boolean
from ..functions.metrics import regression_aggs


def leaderboard(long: DataFrame, scope: Sequence[str] = (), meta: Sequence[str] = (
        "model_family", "feature_set", "parameters", "best_iteration", "eligible"), label: str = "main") -> DataFrame:
    """One row per (scope, model): mae, rmse, r2, smape, rows + rank and selected flag."""
    scope = list(scope)
    meta = [m for m in meta if m in long.columns]
    board = long.groupBy(*scope, "model", *meta).agg(*regression_aggs("actual", "predicted", with_bias=False))
    return select_lowest(board, scope, label)


def select_lowest(board: DataFrame, scope: Sequence[str] = (), label: str = "main") -> DataFrame:
    """Order by (mae, model); selected = first eligible row with finite MAE."""
    scope = list(scope)
    ok = F.coalesce(F.col("eligible"), F.lit(False)) & _finite(F.col("mae"))
    order = Window.partitionBy(*scope).orderBy(F.col("mae").asc_nulls_last(), F.col("model"))
    pick = Window.partitionBy(*scope).orderBy((~ok).cast("int"), F.col("mae").asc_nulls_last(), F.col("model"))
    out = (board.withColumn("rank", F.row_number().over(order))
           .withColumn("selected", ok & (F.row_number().over(pick) == 1)))
    fam = F.col("model_family") if "model_family" in board.columns else F.lit("")
    fs = F.col("feature_set") if "feature_set" in board.columns else F.lit("")
    return out.withColumn("signature", F.when(F.col("selected"), F.concat_ws(
        "|", F.lit(label.upper()), F.concat(F.lit("model="), F.col("model")),
        F.concat(F.lit("family="), fam), F.concat(F.lit("feature_set="), fs),
        F.concat(F.lit("mae="), F.col("mae").cast("string")))))


CHECKS = ["C18_pool_mismatch", "C19_bad_bool", "C19_no_el", "C19_el_not_finite", "C19_dup_names", "C19_not_one_sel", "C19_sel_not_el",
          "C19_not_min", "C23_baseline_eligible_or_selected", "C23_baseline_count"]
STATED = ["C19_stated_model", "C19_stated_family", "C19_stated_feature_set", "C19_stated_mae"]


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _close(a: Column, b: Column, tol: float) -> Column:
    return F.coalesce(F.abs(a - b) <= tol + tol * F.abs(b), F.lit(False))


def _same_scope(scope: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in scope:
        cond = cond & F.col(f"b.{c}").eqNullSafe(F.col(f"s.{c}"))
    return cond


def selection_checks(board: DataFrame, scope: Sequence[str] = (), expected: dict[str, str] | None = None,
                     baselines: Sequence[str] = (), stated: DataFrame | None = None, tol: float = K.SELECTION_TOLERANCE) -> DataFrame:
    """C18/C19/C23 for every scope at once: ``(scope..., check, violations)`` from one keyed aggregate.

    ``board`` is a stored leaderboard; its eligible and selected columns may be boolean or text
    (true/1/yes/y, false/0/no/n), an unparsable value is itself a violation.  ``expected``: the
    documented pool (name -> family) of every scope.  ``stated``: one row per scope with the
    selection that was reported (scope..., model, model_family, feature_set, mae), matched null-safely;
    a scope missing on either side violates all four stated checks.
    """
    scope = list(scope)
    fs = F.col("feature_set") if "feature_set" in board.columns else F.lit(None).cast("string")
    b = board.select(*scope, "model", "model_family", fs.alias("feature_set"), "mae", parse_boolean("eligible").alias("el"), parse_boolean("selected").alias("se"))
    el, se, finite = F.coalesce(F.col("el"), F.lit(False)), F.coalesce(F.col("se"), F.lit(False)), _finite(F.col("mae"))
    pool = F.lit(False)
    for name, family in (expected or {}).items():
        pool = pool | (F.col("model").eqNullSafe(F.lit(name)) & F.col("model_family").eqNullSafe(F.lit(family)))
    is_base = F.col("model").isin(*baselines) if baselines else F.lit(False)
    first = F.struct("mae", "model", "model_family", "feature_set")
    per = b.groupBy(*scope).agg(
        F.count_if(el & ~pool).alias("outside"), F.count_distinct(F.when(el & pool, F.col("model"))).alias("in_pool"),
        F.count_if(F.col("el").isNull() | F.col("se").isNull()).alias("bad_bool"), F.count_if(el).alias("n_el"),
        F.count_if(el & ~finite).alias("el_not_finite"), (F.count(F.lit(1)) - F.count_distinct("model")).alias("dup_names"),
        F.count_if(se).alias("n_sel"), F.count_if(se & ~el).alias("sel_not_el"),
        F.min(F.when(el & finite, F.col("mae"))).alias("min_el"), F.min(F.when(se, first)).alias("sel"),
        F.count_if(is_base & (F.coalesce(F.col("el"), F.lit(True)) | F.coalesce(F.col("se"), F.lit(True)))).alias("base_flags"),
        F.count_if(is_base).alias("n_base"))
    checks = {
        "C18_pool_mismatch": F.col("outside") + (len(expected) - F.col("in_pool")) if expected is not None else None,
        "C19_bad_bool": F.col("bad_bool"), "C19_no_el": (F.col("n_el") == 0).cast("int"), "C19_el_not_finite": F.col("el_not_finite"),
        "C19_dup_names": F.col("dup_names"), "C19_not_one_sel": (F.col("n_sel") != 1).cast("int"), "C19_sel_not_el": F.col("sel_not_el"),
        "C19_not_min": (~_close(F.col("sel.mae"), F.col("min_el"), tol)).cast("int"),
        "C23_baseline_eligible_or_selected": F.col("base_flags") if baselines else None,
        "C23_baseline_count": (F.col("n_base") != len(baselines)).cast("int") if baselines else None}
    if stated is not None:
        said = stated.select(*scope, F.struct("model", "model_family", "feature_set", "mae").alias("said"))
        both = per.alias("b").join(said.alias("s"), _same_scope(scope), "full_outer")
        per = both.select(*[F.coalesce(F.col(f"b.{c}"), F.col(f"s.{c}")).alias(c) for c in scope],
                          *[F.col(f"b.{c}") for c in per.columns if c not in scope], F.col("s.said").alias("said"))
        absent = F.col("sel").isNull() | F.col("said").isNull()
        for check, field in zip(STATED, ("model", "model_family", "feature_set")):
            checks[check] = (absent | ~F.col(f"sel.{field}").eqNullSafe(F.col(f"said.{field}"))).cast("int")
        checks["C19_stated_mae"] = (absent | ~_close(F.col("said.mae"), F.col("sel.mae"), tol)).cast("int")
    rows = F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(0)).cast("long").alias("violations")) for k, v in checks.items() if v is not None])
    return per.select(*scope, F.explode(rows).alias("c")).select(*scope, "c.check", "c.violations")


def selection_contract(board: DataFrame, scope: Sequence[str] = (), expected: dict[str, str] | None = None,
                       baselines: Sequence[str] = (), stated: DataFrame | None = None, tol: float = K.SELECTION_TOLERANCE) -> DataFrame:
    """:func:`selection_checks` summed over all scopes: (check, violations)."""
    checks = selection_checks(board, scope, expected, baselines, stated, tol)
    return checks.groupBy("check").agg(F.sum("violations").alias("violations"))


def stated_selection(board: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The selected row of every scope as it would be reported: (scope..., model, model_family, feature_set, mae)."""
    return board.where("selected").select(*scope, "model", "model_family", "feature_set", "mae")


def screening_table(board: DataFrame, basic: str = "basic_supplied", families: Sequence[str] | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Per feature set the family MAEs, the equal-family mean score, the improvement over the
    basic set, rank and the selected set - for every scope at once.

    ``board`` has (scope..., feature_set, model_family, mae) and may have rmse, r2, smape and
    best_iteration, which become ``<family>_<metric>`` columns.
    """
    scope = list(scope)
    if families is None:
        families = sorted(r[0] for r in board.select("model_family").distinct().collect())   # a few family names
    more = [m for m in ("rmse", "r2", "smape", "best_iteration") if m in board.columns]
    wide = board.groupBy(*scope, "feature_set").agg(*[
        F.max(F.when(F.col("model_family") == f, F.col(m))).alias(f if m == "mae" else f"{f}_{m}") for f in families for m in ("mae", *more)])
    score = sum(F.col(f"`{f}`") for f in families) / F.lit(float(len(families)))
    wide = wide.withColumn("selection_score_mean_mae", score)
    own = Window.partitionBy(*scope)    # a scope holds a handful of feature sets
    base = F.max(F.when(F.col("feature_set") == basic, F.col("selection_score_mean_mae"))).over(own)
    order = own.orderBy(F.col("selection_score_mean_mae").asc_nulls_last(), "feature_set")
    return (wide.withColumn("improvement_over_basic_selection_score", base - F.col("selection_score_mean_mae"))
            .withColumn("rank", F.row_number().over(order))
            .withColumn("selected_for_outer_comparison", (F.col("rank") == 1) & F.col("selection_score_mean_mae").isNotNull()))


def screening_contract(table: DataFrame, sets: Sequence[str], families: Sequence[str], scope: Sequence[str] = (),
                       tol: float = K.SELECTION_TOLERANCE) -> DataFrame:
    """One row per feature set, finite family MAEs, score = mean of families, one selected; summed over scopes."""
    scope = list(scope)
    fam = [F.col(f"`{f}`") for f in families]
    mean = sum(fam) / F.lit(float(len(families)))
    finite = F.lit(True)
    for c in fam:
        finite = finite & _finite(c)
    known = F.col("feature_set").isin(*sets)
    per = table.groupBy(*scope).agg(
        (F.count(F.lit(1)) - F.count_distinct("feature_set")).alias("C21_duplicate_sets"),
        (F.count_if(~F.coalesce(known, F.lit(False))) + len(sets) - F.count_distinct(F.when(known, F.col("feature_set")))).alias("C21_set_mismatch"),
        F.count_if(~finite).alias("C21_metrics_not_finite"),
        F.count_if(~F.coalesce(F.abs(F.col("selection_score_mean_mae") - mean) <= tol, F.lit(False))).alias("C21_score_not_family_mean"),
        F.abs(F.count_if("selected_for_outer_comparison") - 1).alias("C21_not_one_selected"))
    names = [c for c in per.columns if c not in scope]
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names])
    return total.unpivot([], names, "check", "violations")


def reconcile_summary(board: DataFrame, summary: DataFrame, expected: dict[str, str], baselines: Sequence[str],
                      scope: Sequence[str] = (), field: str = "selection", tol: float = K.SELECTION_TOLERANCE) -> DataFrame:
    """C20: a stored leaderboard agrees with a stored run summary (both re-read from disk), scope by scope.

    ``summary`` has one row per scope with a struct ``field`` (model, family, feature_set, mae and,
    if given, mae_text, eligible_models, minimum_eligible_mae).
    """
    kinds = {f.name for f in summary.schema[field].dataType.fields}
    part = summary.select(*scope, F.col(field).alias("x"))
    stated = part.select(*scope, F.col("x.model").alias("model"), F.col("x.family").alias("model_family"), "x.feature_set", "x.mae")
    names = {"C18_pool_mismatch": "C20_pool_changed", "C19_not_one_sel": "C20_not_one_selected", "C19_sel_not_el": "C20_selected_not_eligible",
             "C19_dup_names": "C20_model_names_repeat", "C19_not_min": "C20_selected_not_minimum", "C19_stated_model": "C20_other_model_selected",
             "C19_stated_family": "C20_selection_identity_mismatch", "C19_stated_feature_set": "C20_feature_set_mismatch",
             "C19_stated_mae": "C20_selected_mae_mismatch", "C19_bad_bool": "C20_bad_flags", "C19_el_not_finite": "C20_metrics_not_finite",
             "C23_baseline_eligible_or_selected": "C20_baseline_eligible_or_selected", "C23_baseline_count": "C20_baseline_missing"}
    checks = selection_checks(board, scope, expected, baselines, stated, tol).where(F.col("check").isin(*names))
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    out = checks.groupBy(F.element_at(pairs, F.col("check")).alias("check")).agg(F.sum("violations").alias("violations"))
    el = F.coalesce(parse_boolean("eligible"), F.lit(False))
    facts = board.groupBy(*scope).agg(F.min(F.when(el & _finite(F.col("mae")), F.col("mae"))).alias("least"),
                                      F.array_sort(F.collect_set(F.when(el, F.col("model")))).alias("names"))   # a scope's candidates
    both = facts.alias("b").join(part.alias("s"), _same_scope(list(scope)), "full_outer")
    extra = {}
    if "minimum_eligible_mae" in kinds:
        extra["C20_minimum_eligible_mae"] = F.count_if(~_close(F.col("s.x.minimum_eligible_mae"), F.col("b.least"), tol))
    if "eligible_models" in kinds:
        extra["C20_eligible_models"] = F.count_if(~F.array_sort("s.x.eligible_models").eqNullSafe(F.col("b.names")))
    if "mae_text" in kinds:
        extra["C20_mae_text"] = F.count_if(~_close(F.expr("try_cast(s.x.mae_text AS DOUBLE)"), F.col("s.x.mae"), tol))
    if extra:
        row = both.agg(*[v.cast("long").alias(k) for k, v in extra.items()])
        out = out.unionByName(row.unpivot([], list(extra), "check", "violations"))
    return out
