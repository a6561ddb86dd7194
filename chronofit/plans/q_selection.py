"""SQL-checked queries of keyed selection: many leaderboards made and checked in one job.

The candidates are price formulas over the holdout rows, so that SQL can state them; the
scopes are month x distance band.  Two candidates tie exactly, one lacks some predictions, and
the best of some scopes is a baseline that must not win.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.features import distance_band
from ..functions.metrics import round_doubles
from ..operators.selection import (CHECKS, STATED, leaderboard, reconcile_summary, screening_contract, screening_table, selection_checks,
                                   selection_contract, stated_selection)
from ..sources.sinks import output_dir, write_document, write_table
from . import sql as S
from .catalog import register
from .context import context

SCOPE = ["month", "band"]
POOL = {"flat_a": "Flat", "flat_b": "Flat", "signal": "Signal", "partial": "Signal"}
BASELINES = ["reference"]
_META = [("flat_a", "Flat", "distance", True), ("flat_b", "Flat", "distance", True), ("signal", "Signal", "distance + signal", True),
         ("partial", "Signal", "distance + weight", True), ("reference", K.BASELINE_FAMILY, "distance", False)]
# Roots, so that averages never stand halfway between two rounded numbers.
_PRICE = {"flat_a": "sqrt(963E-2) * distance", "flat_b": "sqrt(963E-2) * distance", "signal": "distance * (sqrt(403E-2) + 6E-1 * quote_signal)",
          "partial": "CASE WHEN weight > 0 THEN sqrt(993E-2) * distance END", "reference": "sqrt(931E-2) * distance + 25E0"}


def scoped_predictions(spark, sf):
    """The long prediction table: a row per holdout row and candidate."""
    rows = context(spark, sf).holdout.select(
        F.date_format("date", "yyyy-MM").alias("month"), distance_band(F.col("distance")).alias("band"), F.col(K.TARGET).alias("actual"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(f).alias("model_family"), F.lit(s).alias("feature_set"), F.lit(e).alias("eligible"),
                                     F.expr(_PRICE[n]).alias("predicted")) for n, f, s, e in _META])).alias("c"))
    return rows.select("month", "band", "actual", "c.*")


_LONG_SQL = "plong AS (" + " UNION ALL ".join(
    f"SELECT strftime(date, '%Y-%m') AS month, {S.band('distance')} AS band, posted_rate AS actual, '{n}' AS model, '{f}' AS model_family,"
    f" '{s}' AS feature_set, {str(e).lower()} AS eligible, {_PRICE[n]} AS predicted FROM holdout" for n, f, s, e in _META) + ")"
_BOARD_SQL = f"""pboard AS (
  SELECT month, band, model, model_family, feature_set, eligible, count(*) AS rows,
    CASE WHEN whole THEN mae END AS mae, CASE WHEN whole THEN rmse END AS rmse, CASE WHEN whole THEN r2 END AS r2, CASE WHEN whole THEN smape END AS smape
  FROM (SELECT month, band, model, model_family, feature_set, eligible, count(predicted) = count(*) AS whole, {S.metrics(rows=False, bias=False)}, count(*) AS n
        FROM plong GROUP BY month, band, model, model_family, feature_set, eligible) g, range(n) GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY month, band ORDER BY mae NULLS LAST, model) AS INTEGER) AS rank,
    eligible AND mae IS NOT NULL AND isfinite(mae)
      AND row_number() OVER (PARTITION BY month, band ORDER BY (eligible AND mae IS NOT NULL) DESC, mae NULLS LAST, model) = 1 AS selected
  FROM pboard)""".replace("count(*) AS rows,\n", "n AS rows,\n").replace(", range(n) GROUP BY ALL", "")


@register("selection_leaderboard", S.with_fixture(S.SPLIT_SQL, _LONG_SQL, _BOARD_SQL) + "\n" + S.rounded(
    "SELECT *, CASE WHEN selected THEN 'SEGMENT|model=' || model || '|family=' || model_family || '|feature_set=' || feature_set END AS signature FROM ranked",
    ["mae", "rmse", "r2", "smape"], ["month", "band", "model", "model_family", "feature_set", "eligible", "rows", "rank", "selected", "signature"]))
def q_selection_leaderboard(spark, sf):
    """A leaderboard per month and distance band, with ties, missing predictions and an ineligible best."""
    board = leaderboard(scoped_predictions(spark, sf), SCOPE, label="segment")
    # the identity's last part is the unrounded MAE in the engine's own digits: compared by the contracts instead
    return round_doubles(board.withColumn("signature", F.regexp_extract("signature", r"^(.*)\|mae=", 1)).withColumn(
        "signature", F.when(F.col("selected"), F.col("signature"))))


_LIES = {  # by month number mod 6
    1: "the worst candidate is marked as selected", 2: "an eligible flag that is no boolean", 3: "a name twice, once with another family",
    4: "an eligible baseline", 5: "an infinite error of an eligible candidate"}


def planted(board, said):
    """A stored board with text flags and a lie for most months, and the selections as reported."""
    kind = F.substring("month", 6, 2).cast("int") % 6
    last = F.col("model") == "signal"
    stored = board.select(
        *SCOPE, "model", "model_family", "feature_set",
        F.when((kind == 5) & (F.col("model") == "flat_b"), F.lit(float("inf"))).otherwise(F.col("mae")).alias("mae"),
        F.when((kind == 2) & last, "maybe").when((kind == 4) & (F.col("model") == "reference"), "YES").when(F.col("eligible"), " True ").otherwise("0").alias("eligible"),
        F.when(kind == 1, last.cast("string")).when(F.col("selected"), "y").otherwise("n").alias("selected"))
    twice = stored.where((kind == 3) & (F.col("model") == "flat_a")).withColumns({"model_family": F.lit("Other"), "selected": F.lit("no")})
    band = F.col("band")
    said = said.where(~((kind == 0) & (band == "Short"))).select(
        *SCOPE, F.when((kind == 0) & (band == "Medium"), "flat_c").otherwise(F.col("model")).alias("model"), "model_family",
        F.when((kind == 0) & (band == "Long"), F.lit(None)).otherwise(F.col("feature_set")).alias("feature_set"),
        F.when(band == "Very Long", F.col("mae") * 1.001).otherwise(F.col("mae")).alias("mae"))
    return stored.unionByName(twice), said


_KIND = "CAST(substr(month, 6, 2) AS INTEGER) % 6"
_VIOLATIONS_SQL = f"""stored AS (
  SELECT month, band, model, model_family, feature_set, CASE WHEN {_KIND} = 5 AND model = 'flat_b' THEN CAST('inf' AS DOUBLE) ELSE mae END AS mae,
    CASE WHEN {_KIND} = 2 AND model = 'signal' THEN NULL WHEN {_KIND} = 4 AND model = 'reference' THEN true ELSE eligible END AS el,
    CASE WHEN {_KIND} = 1 THEN model = 'signal' ELSE selected END AS se FROM ranked
  UNION ALL SELECT month, band, model, 'Other', feature_set, mae, true, false FROM ranked WHERE {_KIND} = 3 AND model = 'flat_a'),
said AS (
  SELECT month, band, CASE WHEN {_KIND} = 0 AND band = 'Medium' THEN 'flat_c' ELSE model END AS model, model_family,
    CASE WHEN {_KIND} = 0 AND band = 'Long' THEN NULL ELSE feature_set END AS feature_set, CASE WHEN band = 'Very Long' THEN mae * 1001E-3 ELSE mae END AS mae
  FROM ranked WHERE selected AND NOT ({_KIND} = 0 AND band = 'Short')),
per AS (
  SELECT month, band,
    count_if(coalesce(el, false) AND NOT pooled) + 4 - count(DISTINCT CASE WHEN el AND pooled THEN model END) AS c18,
    count_if(el IS NULL OR se IS NULL) AS bad, count_if(coalesce(el, false)) AS n_el, count_if(coalesce(el, false) AND (mae IS NULL OR NOT isfinite(mae))) AS nf,
    count(*) - count(DISTINCT model) AS dup, count_if(coalesce(se, false)) AS n_sel, count_if(coalesce(se, false) AND NOT coalesce(el, false)) AS sne,
    min(CASE WHEN el AND isfinite(mae) THEN mae END) AS least, min(CASE WHEN se THEN mae END) AS sm, min(CASE WHEN se THEN model END) AS s_model,
    min(CASE WHEN se THEN model_family END) AS s_family, min(CASE WHEN se THEN feature_set END) AS s_set,
    count_if(model = 'reference' AND (coalesce(el, true) OR coalesce(se, true))) AS base, count_if(model = 'reference') AS n_base
  FROM (SELECT *, (model, model_family) IN ({', '.join(f"('{n}', '{f}')" for n, f in POOL.items())}) AS pooled FROM stored) x GROUP BY month, band),
both_sides AS (
  SELECT p.*, s.month IS NULL OR s_model IS NULL AS absent, s.model, s.model_family, s.feature_set, s.mae
  FROM per p LEFT JOIN said s ON p.month = s.month AND p.band = s.band),
wide AS (SELECT month, band, c18 AS "C18_pool_mismatch", bad AS "C19_bad_bool", CAST(n_el = 0 AS BIGINT) AS "C19_no_el", nf AS "C19_el_not_finite",
  dup AS "C19_dup_names", CAST(n_sel <> 1 AS BIGINT) AS "C19_not_one_sel", sne AS "C19_sel_not_el",
  CAST(NOT coalesce(abs(sm - least) <= 1E-12 + 1E-12 * abs(least), false) AS BIGINT) AS "C19_not_min",
  base AS "C23_baseline_eligible_or_selected", CAST(n_base <> 1 AS BIGINT) AS "C23_baseline_count",
  CAST(absent OR s_model IS DISTINCT FROM model AS BIGINT) AS "C19_stated_model",
  CAST(absent OR s_family IS DISTINCT FROM model_family AS BIGINT) AS "C19_stated_family",
  CAST(absent OR s_set IS DISTINCT FROM feature_set AS BIGINT) AS "C19_stated_feature_set",
  CAST(absent OR NOT coalesce(abs(mae - sm) <= 1E-12 + 1E-12 * abs(sm), false) AS BIGINT) AS "C19_stated_mae" FROM both_sides)"""


@register("selection_violations", S.with_fixture(S.SPLIT_SQL, _LONG_SQL, _BOARD_SQL, _VIOLATIONS_SQL) + "\n" + " UNION ALL ".join(
    f"SELECT month, band, '{c}' AS \"check\", CAST(\"{c}\" AS BIGINT) AS violations FROM wide" for c in CHECKS + STATED))
def q_selection_violations(spark, sf):
    """Every check of every scope on a stored board with planted lies and misreported selections."""
    board = leaderboard(scoped_predictions(spark, sf), SCOPE, label="segment")
    stored, said = planted(board, stated_selection(board, SCOPE))
    stored = write_table(stored, output_dir(spark, "board"))
    return selection_checks(stored, SCOPE, POOL, BASELINES, said)


@register("selection_reconciliation", S.with_fixture(S.SPLIT_SQL, _LONG_SQL, _BOARD_SQL) + """
SELECT * FROM (VALUES """ + ", ".join(f"('{c}', CAST(0 AS BIGINT))" for c in [
    "C20_bad_flags", "C20_baseline_eligible_or_selected", "C20_baseline_missing", "C20_eligible_models", "C20_feature_set_mismatch",
    "C20_minimum_eligible_mae", "C20_model_names_repeat", "C20_not_one_selected", "C20_other_model_selected", "C20_pool_changed",
    "C20_selected_mae_mismatch", "C20_selected_not_eligible", "C20_selected_not_minimum", "C20_selection_identity_mismatch"]) + """) t("check", violations)
UNION ALL SELECT 'C20_metrics_not_finite', (SELECT count_if(eligible AND mae IS NULL) FROM ranked)""")
def q_selection_reconciliation(spark, sf):
    """The board and the summary document of every scope, written, re-read and reconciled in one job."""
    board = leaderboard(scoped_predictions(spark, sf), SCOPE, label="segment")
    folder = output_dir(spark, "segments")
    stored = write_table(board, f"{folder}/board")
    best = board.groupBy(*SCOPE).agg(F.min(F.when(F.col("eligible"), F.col("mae"))).alias("minimum_eligible_mae"),
                                     F.array_sort(F.collect_set(F.when(F.col("eligible"), F.col("model")))).alias("eligible_models"))
    chosen = board.where("selected").join(best, SCOPE).select(*SCOPE, F.struct(
        "model", F.col("model_family").alias("family"), "feature_set", "mae", "minimum_eligible_mae", "eligible_models").alias("selection"))
    write_document(chosen, f"{folder}/summary")
    return reconcile_summary(stored, spark.read.json(f"{folder}/summary"), POOL, BASELINES, scope=SCOPE)


_SCREEN_SQL = """sboard AS (SELECT month, feature_set, model_family, min(mae) AS mae FROM (
    SELECT month, feature_set, model_family, model, avg(abs(predicted - actual)) AS mae FROM plong WHERE model NOT IN ('partial', 'flat_b')
    GROUP BY month, feature_set, model_family, model
    UNION ALL SELECT month, 'distance + signal', 'Flat', 'x', avg(abs(3E0 * actual - 3E0 * actual + predicted - actual) * 11E-1) FROM plong WHERE model = 'flat_a' GROUP BY month
    UNION ALL SELECT month, 'distance', 'Signal', 'x', avg(abs(predicted - actual) * 105E-2) FROM plong WHERE model = 'signal' GROUP BY month)
  WHERE model_family <> 'Baseline' GROUP BY month, feature_set, model_family),
swide AS (SELECT month, feature_set, max(CASE WHEN model_family = 'Flat' THEN mae END) AS "Flat", max(CASE WHEN model_family = 'Signal' THEN mae END) AS "Signal"
  FROM sboard GROUP BY month, feature_set),
sscore AS (SELECT *, ("Flat" + "Signal") / 2E0 AS selection_score_mean_mae FROM swide),
sout AS (SELECT *, max(CASE WHEN feature_set = 'distance' THEN selection_score_mean_mae END) OVER (PARTITION BY month) - selection_score_mean_mae
    AS improvement_over_basic_selection_score,
  CAST(row_number() OVER (PARTITION BY month ORDER BY selection_score_mean_mae, feature_set) AS INTEGER) AS rank FROM sscore)"""


def monthly_screening(spark, sf):
    """A screening table for every month: two feature sets by two families of price formulas."""
    rows = scoped_predictions(spark, sf)
    err = F.abs(F.col("predicted") - F.col("actual"))

    def mae(model, fs, family, factor=1.0):
        return rows.where(F.col("model") == model).groupBy("month").agg(F.avg(err * factor).alias("mae")).select(
            "month", F.lit(fs).alias("feature_set"), F.lit(family).alias("model_family"), "mae")
    board = (mae("flat_a", "distance", "Flat").unionByName(mae("signal", "distance + signal", "Signal"))
             .unionByName(mae("flat_a", "distance + signal", "Flat", 1.1)).unionByName(mae("signal", "distance", "Signal", 1.05)))
    return screening_table(board, basic="distance", families=["Flat", "Signal"], scope=["month"])


@register("monthly_screening", S.with_fixture(S.SPLIT_SQL, _LONG_SQL, _SCREEN_SQL) + "\n" + S.rounded(
    "SELECT *, rank = 1 AS selected_for_outer_comparison FROM sout", ['"Flat"', '"Signal"', "selection_score_mean_mae", "improvement_over_basic_selection_score"],
    ["month", "feature_set", "rank", "selected_for_outer_comparison"]))
def q_monthly_screening(spark, sf):
    """Equal-family scores, improvement over the basic set and the selected set, for every month at once."""
    return round_doubles(monthly_screening(spark, sf))


@register("screening_violations", S.with_fixture(S.SPLIT_SQL) + """
SELECT 'C21_duplicate_sets' AS "check", count(*) AS violations FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS m FROM holdout) WHERE CAST(substr(m, 6, 2) AS INTEGER) % 3 = 0
UNION ALL SELECT 'C21_set_mismatch', count(*) FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS m FROM holdout) WHERE CAST(substr(m, 6, 2) AS INTEGER) % 3 = 1
UNION ALL SELECT 'C21_metrics_not_finite', 0
UNION ALL SELECT 'C21_score_not_family_mean', count(*) FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS m FROM holdout) WHERE CAST(substr(m, 6, 2) AS INTEGER) % 3 = 2
UNION ALL SELECT 'C21_not_one_selected', count(*) FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS m FROM holdout) WHERE CAST(substr(m, 6, 2) AS INTEGER) % 3 = 0""")
def q_screening_violations(spark, sf):
    """C21 on tables with planted lies: a set twice (and selected twice), a set under another name, a wrong score."""
    table = monthly_screening(spark, sf)
    kind, chosen = F.substring("month", 6, 2).cast("int") % 3, F.col("selected_for_outer_comparison")
    lied = table.withColumns({
        "feature_set": F.when((kind == 1) & chosen, F.lit("renamed")).otherwise(F.col("feature_set")),
        "selection_score_mean_mae": F.when((kind == 2) & chosen, F.col("selection_score_mean_mae") * 0.9).otherwise(F.col("selection_score_mean_mae"))})
    checks = screening_contract(lied.unionByName(lied.where((kind == 0) & chosen)), ["distance", "distance + signal"], ["Flat", "Signal"], ["month"])
    # a renamed set is one that is unknown and one that is missing: counted once here
    return checks.withColumn("violations", F.when(F.col("check") == "C21_set_mismatch", F.col("violations") / 2).otherwise(F.col("violations")).cast("long"))
