"""SQL-checkable queries (each has a DuckDB oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.metrics import round_doubles
from ..operators.baselines import group_median_rpm
from ..operators.errors import daily_errors, holdout_errors, segment_errors
from ..sources import fixture
from . import sql as S
from .catalog import register
from .context import context

# ---------------------------------------------------------------------------
# Minimum slice: how wrong is the group-median price per mile, by segment?
# ---------------------------------------------------------------------------

_ERR_SQL = f"""tr AS (SELECT {S.norm('equipment')} AS g, posted_rate / distance AS rpm FROM training),
gm AS (SELECT g, quantile_cont(rpm, 0.5) AS m FROM tr GROUP BY g),
pred AS (SELECT h.*, coalesce(gm.m, (SELECT quantile_cont(rpm, 0.5) FROM tr)) * h.distance AS predicted
         FROM holdout h LEFT JOIN gm ON {S.norm('h.equipment')} = gm.g),
rc AS (SELECT pickup || ' > ' || delivery AS route, count(*) AS n FROM training GROUP BY 1),
sp AS (SELECT DISTINCT pickup AS p FROM training),
sd AS (SELECT DISTINCT delivery AS d FROM training),
qb AS (SELECT quantile_cont(posted_rate, 0.25) AS q1, quantile_cont(posted_rate, 0.75) AS q3 FROM pred),
err AS (
  SELECT load_id, date, posted_rate AS actual, predicted, predicted - posted_rate AS residual,
         abs(predicted - posted_rate) AS absolute_error, strftime(date, '%Y-%m') AS month,
         {S.band('distance')} AS distance_band, equipment,
         CASE WHEN posted_rate <= (SELECT q1 FROM qb) THEN 'Low'
              WHEN posted_rate <= (SELECT q3 FROM qb) THEN 'Medium' ELSE 'High' END AS target_band,
         CASE WHEN coalesce(rc.n, 0) = 0 THEN 'Unseen' WHEN rc.n < {K.RARE_THRESHOLD} THEN 'Rare (<10)'
              ELSE 'Common (>=10)' END AS route_status,
         CASE WHEN sp.p IS NULL OR sd.d IS NULL THEN 'Unseen city' ELSE 'Seen cities' END AS city_status
  FROM pred LEFT JOIN rc ON pred.pickup || ' > ' || pred.delivery = rc.route
            LEFT JOIN sp ON pred.pickup = sp.p LEFT JOIN sd ON pred.delivery = sd.d)"""

_SEG_UNION = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS segment, {S.metrics()} FROM err GROUP BY {d}"
    for d in ["month", "distance_band", "equipment", "target_band", "route_status", "city_status"])
_METRIC_COLS = ["mae", "rmse", "r2", "smape", "mean_error"]


def baseline_errors(spark, sf):
    c = context(spark, sf)
    pred = group_median_rpm(c.training, c.holdout)
    return holdout_errors(pred, c.training)


@register("baseline_segment_errors", S.with_fixture(S.SPLIT_SQL, _ERR_SQL) + "\n" + S.rounded(
    _SEG_UNION, _METRIC_COLS, ["dimension", "segment", "rows"]))
def q_baseline_segment_errors(spark, sf):
    """Group-median rpm baseline errors by six segment dimensions."""
    return round_doubles(segment_errors(baseline_errors(spark, sf)))


@register("baseline_daily_errors", S.with_fixture(S.SPLIT_SQL, _ERR_SQL) + "\n" + S.rounded(
    "SELECT date, count(*) AS rows, avg(absolute_error) AS mae, avg(residual) AS bias FROM err GROUP BY date",
    ["mae", "bias"], ["date", "rows"]))
def q_baseline_daily_errors(spark, sf):
    """Holdout MAE and bias per day."""
    return round_doubles(daily_errors(baseline_errors(spark, sf)))


@register("holdout_predictions", S.with_fixture(S.SPLIT_SQL, _ERR_SQL) + "\n" + S.rounded(
    "SELECT load_id, date, actual, predicted, residual, absolute_error, distance_band, route_status, city_status,"
    " month, equipment, target_band FROM err",
    ["actual", "predicted", "residual", "absolute_error"],
    ["load_id", "date", "distance_band", "route_status", "city_status", "month", "equipment", "target_band"]))
def q_holdout_predictions(spark, sf):
    """The per-row holdout error table with segment keys."""
    e = baseline_errors(spark, sf)
    return round_doubles(e.select("load_id", "date", "actual", "predicted", "residual", "absolute_error",
                                  "distance_band", "route_status", "city_status", "month", "equipment",
                                  "target_band"))


@register("loads_fixture", S.with_fixture() + "\n" + S.rounded(
    "SELECT * FROM loads",
    ["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance", "weight", "market_index",
     "quote_signal", "posted_rate"],
    ["load_id", "pickup_key", "delivery_key", "pickup", "delivery", "equipment", "date"]))
def q_loads_fixture(spark, sf):
    """The typed load table built from the driver's tables (copies numbered skew-safely)."""
    return round_doubles(fixture.loads(spark, sf))


# ---------------------------------------------------------------------------
# Data audit
# ---------------------------------------------------------------------------
from ..operators import audit as A  # noqa: E402

_DEV_COLS = K.LOAD_COLUMNS + [K.TARGET]
_TABLE_COLS = {"development": _DEV_COLS, "validation": K.LOAD_COLUMNS, "scenario": K.SCENARIO_COLUMNS}
_DOUBLE_COLS = set(K.RAW_NUMERIC + [K.TARGET])


def _tables(spark, sf):
    c = context(spark, sf)
    return {"development": c.development, "validation": c.validation, "scenario": fixture.scenario(spark, sf)}


def _missing_sql():
    parts = []
    for t, cols in _TABLE_COLS.items():
        for col in cols:
            miss = f"{col} IS NULL OR isnan({col})" if col in _DOUBLE_COLS else f"{col} IS NULL"
            parts.append(f"SELECT '{t}' AS dataset, '{col}' AS \"column\", CAST(count_if({miss}) AS BIGINT) "
                         f"AS missing_count, 100E0 * count_if({miss}) / count(*) AS missing_percent FROM {t}")
    return " UNION ALL ".join(parts)


@register("missing_values", S.with_fixture(S.SCENARIO_SQL) + "\n" + S.rounded(
    _missing_sql(), ["missing_percent"], ["dataset", '"column"', "missing_count"]))
def q_missing_values(spark, sf):
    """A1: missing count and percent per column of the three input tables."""
    return round_doubles(A.missing_values(_tables(spark, sf)))


def _numsum_sql():
    parts = []
    for t in ["development", "validation"]:
        for col in A.AUDIT_NUMERICS:
            v = f"abs({col})" if col == "weight" else col
            parts.append(
                f"SELECT '{t}' AS dataset, '{col}' AS \"column\", count({v}) AS count, avg({v}) AS mean,"
                f" stddev_samp({v}) AS std, min({v}) AS min, quantile_cont({v}, 0.5) AS median,"
                f" quantile_cont({v}, 0.95) AS p95, max({v}) AS max, count_if({col} IS NULL) AS missing,"
                f" count_if({col} <= 0) AS non_positive FROM {t}")
    return " UNION ALL ".join(parts)


@register("numeric_summary", S.with_fixture() + "\n" + S.rounded(
    _numsum_sql(), ["mean", "std", "min", "median", "p95", "max"],
    ["dataset", '"column"', "count", "missing", "non_positive"]))
def q_numeric_summary(spark, sf):
    """A2/P25: per table and numeric column: count, mean, std, min, median, p95, max, missing, non-positive."""
    c = context(spark, sf)
    return round_doubles(A.numeric_summary({"development": c.development, "validation": c.validation}))


def _catshift_sql():
    parts = []
    for col in A.AUDIT_CATEGORIES:
        parts.append(f"""SELECT '{col}' AS "column",
          (SELECT count(DISTINCT {col}) FROM development) AS development_unique,
          (SELECT count(DISTINCT {col}) FROM validation) AS validation_unique,
          (SELECT count(DISTINCT {col}) FROM validation WHERE {col} NOT IN (SELECT {col} FROM development
                                                                            WHERE {col} IS NOT NULL)) AS unseen_categories,
          coalesce((SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT {col} AS v FROM validation
               WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {col} FROM development WHERE {col} IS NOT NULL))), '')
               AS unseen_values,
          (SELECT count(*) FROM validation WHERE {col} IS NOT NULL AND {col} NOT IN
               (SELECT {col} FROM development WHERE {col} IS NOT NULL)) AS validation_rows_with_unseen""")
    return " UNION ALL ".join(parts)


@register("category_shift", S.with_fixture() + "\n" + _catshift_sql())
def q_category_shift(spark, sf):
    """Category uniques, unseen validation categories and the rows carrying them."""
    c = context(spark, sf)
    return A.category_shift(c.development, c.validation)


def _shift_sql():
    parts = []
    for col in A.AUDIT_NUMERICS:
        v = f"abs({col})" if col == "weight" else col
        parts.append(f"""SELECT '{col}' AS feature, d.m AS development_mean, w.m AS validation_mean,
          CASE WHEN sqrt((d.v + w.v) / 2) > 0 THEN (w.m - d.m) / sqrt((d.v + w.v) / 2) ELSE 0E0 END
            AS standardized_mean_difference,
          abs(CASE WHEN sqrt((d.v + w.v) / 2) > 0 THEN (w.m - d.m) / sqrt((d.v + w.v) / 2) ELSE 0E0 END)
            >= {K.SHIFT_FLAG_SMD} AS shift_flagged
          FROM (SELECT avg({v}) AS m, var_samp({v}) AS v FROM development) d,
               (SELECT avg({v}) AS m, var_samp({v}) AS v FROM validation) w""")
    return " UNION ALL ".join(parts)


@register("distribution_shift", S.with_fixture() + "\n" + S.rounded(
    _shift_sql(), ["development_mean", "validation_mean", "standardized_mean_difference"],
    ["feature", "shift_flagged"]))
def q_distribution_shift(spark, sf):
    """Development vs validation means and standardised mean difference, |SMD| >= 0.5 flag."""
    c = context(spark, sf)
    return round_doubles(A.distribution_shift(c.development, c.validation))


_TD_SQL = """SELECT count(posted_rate) AS count, avg(posted_rate) AS mean, stddev_samp(posted_rate) AS std,
  min(posted_rate) AS min, quantile_cont(posted_rate, 0.05) AS p05, quantile_cont(posted_rate, 0.5) AS median,
  quantile_cont(posted_rate, 0.95) AS p95, quantile_cont(posted_rate, 0.99) AS p99, max(posted_rate) AS max,
  skewness(posted_rate) AS skew FROM development"""


@register("target_distribution", S.with_fixture() + "\n" + S.rounded(
    _TD_SQL, ["mean", "std", "min", "p05", "median", "p95", "p99", "max", "skew"], ["count"]))
def q_target_distribution(spark, sf):
    """Target count, mean, std, quantiles and bias-corrected skew."""
    return round_doubles(A.target_distribution(context(spark, sf).development))


@register("monthly_target", S.with_fixture() + "\n" + S.rounded(
    "SELECT strftime(date, '%Y-%m') AS month, avg(posted_rate) AS mean, quantile_cont(posted_rate, 0.5) AS median"
    " FROM development GROUP BY 1", ["mean", "median"], ["month"]))
def q_monthly_target(spark, sf):
    """Monthly target mean and median."""
    return round_doubles(A.monthly_target(context(spark, sf).development))


_HIST_SQL = f"""cap AS (SELECT quantile_cont(posted_rate, {K.HISTOGRAM_CAP_QUANTILE}) AS c FROM development),
capped AS (SELECT least(posted_rate, (SELECT c FROM cap)) AS x FROM development),
rng AS (SELECT min(x) AS lo, (max(x) - min(x)) / {K.HISTOGRAM_BINS} AS w FROM capped),
binned AS (SELECT CAST(CASE WHEN (SELECT w FROM rng) > 0
                   THEN least(floor((x - (SELECT lo FROM rng)) / (SELECT w FROM rng)), {K.HISTOGRAM_BINS - 1})
                   ELSE 0 END AS INTEGER) AS bin FROM capped)"""


@register("target_histogram", S.with_fixture(_HIST_SQL) + "\n" + S.rounded(
    "SELECT bin, (SELECT lo FROM rng) + bin * (SELECT w FROM rng) AS bin_start,"
    " (SELECT lo FROM rng) + (bin + 1) * (SELECT w FROM rng) AS bin_end, count(*) AS rows FROM binned GROUP BY bin",
    ["bin_start", "bin_end"], ["bin", "rows"]))
def q_target_histogram(spark, sf):
    """45-bin histogram of the target capped at its 99.5th percentile."""
    return round_doubles(A.target_histogram(context(spark, sf).development))


_ROUTE_SQL = f"""dr AS (SELECT pickup || ' > ' || delivery AS route, count(*) AS n FROM development GROUP BY 1),
vr AS (SELECT pickup || ' > ' || delivery AS route, count(*) AS vn FROM validation GROUP BY 1)"""


@register("route_stats", S.with_fixture(_ROUTE_SQL) + "\n" + f"""SELECT
  (SELECT count(*) FROM dr) AS development_unique, (SELECT count_if(n < 5) FROM dr) AS frequency_below_5,
  (SELECT CAST(coalesce(sum(vn), 0) AS BIGINT) FROM vr LEFT JOIN dr USING (route) WHERE dr.n IS NULL)
     AS validation_unseen_rows,
  (SELECT CAST(coalesce(sum(vn), 0) AS BIGINT) FROM vr JOIN dr USING (route) WHERE dr.n BETWEEN 1 AND {K.RARE_THRESHOLD - 1})
     AS validation_rare_seen_rows""")
def q_route_stats(spark, sf):
    """Labeled route counts and validation rows on unseen / rare routes."""
    c = context(spark, sf)
    return A.route_stats(c.development, c.validation)


_HAV_SQL = """geo AS (SELECT distance,
  3958.7613 * 2 * atan2(sqrt(least(greatest(pow(sin((radians(delivery_lat) - radians(pickup_lat)) / 2), 2)
     + cos(radians(pickup_lat)) * cos(radians(delivery_lat)) * pow(sin(radians(delivery_lon - pickup_lon) / 2), 2), 0), 1)),
     sqrt(1 - least(greatest(pow(sin((radians(delivery_lat) - radians(pickup_lat)) / 2), 2)
     + cos(radians(pickup_lat)) * cos(radians(delivery_lat)) * pow(sin(radians(delivery_lon - pickup_lon) / 2), 2), 0), 1)))
     AS hav,
  NOT (coalesce(pickup_lat BETWEEN -90 AND 90, false) AND coalesce(delivery_lat BETWEEN -90 AND 90, false)) AS bl,
  NOT (coalesce(pickup_lon BETWEEN -180 AND 180, false) AND coalesce(delivery_lon BETWEEN -180 AND 180, false)) AS bo
  FROM development)"""

_AUDIT_SQL = f"""SELECT
  (SELECT count(*) FROM development) AS development_rows, {len(_DEV_COLS)} AS development_columns,
  (SELECT count(*) FROM validation) AS validation_rows, {len(K.LOAD_COLUMNS)} AS validation_columns,
  (SELECT count(*) FROM scenario) AS scenario_rows, {len(K.SCENARIO_COLUMNS)} AS scenario_columns,
  '{K.TARGET}' AS target,
  (SELECT min(date) FROM development) AS development_date_start, (SELECT max(date) FROM development) AS development_date_end,
  (SELECT min(date) FROM validation) AS validation_date_start, (SELECT max(date) FROM validation) AS validation_date_end,
  (SELECT min(date) FROM validation) > (SELECT max(date) FROM development) AS validation_strictly_later,
  (SELECT count(DISTINCT pickup) FROM development) AS unique_pickup_cities,
  (SELECT count(DISTINCT delivery) FROM development) AS unique_delivery_cities,
  (SELECT count(*) FROM development) - (SELECT count(*) FROM (SELECT DISTINCT * FROM development)) AS duplicate_rows_development,
  (SELECT count(*) FROM validation) - (SELECT count(*) FROM (SELECT DISTINCT * FROM validation)) AS duplicate_rows_validation,
  (SELECT count(*) - count(DISTINCT load_id) - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END) FROM development) AS duplicate_ids_development,
  (SELECT count(*) - count(DISTINCT load_id) - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END) FROM validation) AS duplicate_ids_validation,
  (SELECT count_if(date IS NULL) FROM development) AS invalid_dates_development,
  (SELECT count_if(date IS NULL) FROM validation) AS invalid_dates_validation,
  (SELECT count_if(weight < 0) FROM development) AS negative_weight_rows_development,
  (SELECT count_if(weight < 0) FROM validation) AS negative_weight_rows_validation,
  (SELECT count_if(bl) FROM geo) AS invalid_latitude_rows, (SELECT count_if(bo) FROM geo) AS invalid_longitude_rows,
  round((SELECT corr(distance, hav) FROM geo), 6) AS distance_haversine_correlation,
  round((SELECT quantile_cont(distance / CASE WHEN hav IS NULL THEN NULL ELSE greatest(hav, 1E0) END, 0.5) FROM geo), 6)
     AS median_distance_haversine_ratio"""


@register("data_audit", S.with_fixture(S.SCENARIO_SQL, _HAV_SQL) + "\n" + _AUDIT_SQL)
def q_data_audit(spark, sf):
    """Shapes, date ranges, uniques, duplicates, invalid values, distance vs haversine."""
    t = _tables(spark, sf)
    return round_doubles(A.data_audit(t["development"], t["validation"], t["scenario"]))


@register("equipment_counts", S.with_fixture() + "\nSELECT 'equipment' AS \"column\", equipment AS value,"
          " count(*) AS rows FROM development GROUP BY equipment")
def q_equipment_counts(spark, sf):
    """Value counts of the raw equipment column."""
    return A.value_counts(context(spark, sf).development, "equipment")


@register("scenario_grid", S.with_fixture(S.SCENARIO_SQL) + "\n" + S.rounded(
    "SELECT * FROM scenario", ["distance", "weight"], ["pickup", "delivery", "equipment", "date"]))
def q_scenario_grid(spark, sf):
    """The reduced-schema scenario grid derived from the labeled table."""
    return round_doubles(fixture.scenario(spark, sf))


# ---------------------------------------------------------------------------
# Feature engine: fitted state tables and the full transform (E1-E9, J1, J2, §2.4-2.6)
# ---------------------------------------------------------------------------
from ..operators import features as FE  # noqa: E402
from . import sql_features as SF  # noqa: E402
from .context import fitted_state  # noqa: E402

ALL_FEATURES = list(dict.fromkeys(K.BASIC_FEATURES + K.DATE_FEATURES + K.ROUTE_FEATURES
                                  + K.GEOGRAPHIC_FEATURES + K.INTERACTION_FEATURES))
_FEATURE_DOUBLES = [c for c in ALL_FEATURES if c not in K.CATEGORICAL_FEATURES and c not in {
    "weight_missing", "weight_sign_corrected", "market_index_missing", "year", "month", "quarter", "week_of_year",
    "day_of_month", "day_of_year", "day_of_week", "weekend", "month_start", "month_end", "days_since_start",
    "federal_holiday", "near_thanksgiving", "near_christmas", "rare_pickup", "rare_delivery", "rare_route",
    "unseen_pickup", "unseen_delivery", "unseen_route"}]


@register("feature_state_counts", S.with_fixture(S.SPLIT_SQL, SF.state_ctes()) + "\n" + S.rounded(
    "SELECT * FROM fs_counts", ["frequency"], ["key_column", "key", "count"]))
def q_feature_state_counts(spark, sf):
    """Training counts and frequencies of the seven (composite) keys."""
    return round_doubles(fitted_state(spark, sf).counts)


_CODE_COLUMNS = ["pickup", "delivery", "equipment", "route"]
_CODES_SQL = f"""names AS (SELECT raw, {S.norm('raw')} AS v FROM (
    SELECT pickup AS raw FROM development UNION SELECT delivery FROM development UNION SELECT equipment FROM development)),
named AS (SELECT d.load_id, d.date, p.v AS pickup, q.v AS delivery, e.v AS equipment, p.v || ' > ' || q.v AS route
  FROM development d LEFT JOIN names p ON p.raw IS NOT DISTINCT FROM d.pickup LEFT JOIN names q ON q.raw IS NOT DISTINCT FROM d.delivery
  LEFT JOIN names e ON e.raw IS NOT DISTINCT FROM d.equipment),
""" + ", ".join(f"code_{c} AS (SELECT {c} AS v, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code FROM"
                f" (SELECT DISTINCT {c} FROM named WHERE date < (SELECT cutoff FROM cut)))" for c in _CODE_COLUMNS)


@register("ordinal_codes", S.with_fixture(S.SPLIT_SQL, _CODES_SQL) + "\nSELECT load_id, " + ", ".join(
    f"coalesce(code_{c}.code, -1) AS {c}_code" for c in _CODE_COLUMNS) + " FROM named n " + " ".join(
    f"LEFT JOIN code_{c} ON code_{c}.v = n.{c}" for c in _CODE_COLUMNS) + " WHERE n.date >= (SELECT cutoff FROM cut)")
def q_ordinal_codes(spark, sf):
    """M1: ordinal codes of the holdout's categories, from the distributed dictionary of the training rows."""
    from ..operators.encoding import encode, fit_codes
    from ..operators.lookup import stored_table
    c = context(spark, sf)
    state = fitted_state(spark, sf)
    features = [FE.transform(state, rows, _CODE_COLUMNS, keep=["load_id"]) for rows in (c.training, c.holdout)]
    codes, n = stored_table(fit_codes(features[0], _CODE_COLUMNS), "ordinal_codes")
    return encode(features[1], codes, _CODE_COLUMNS, n).select("load_id", *[F.col(f"__ix_{k}").cast("long").alias(f"{k}_code") for k in _CODE_COLUMNS])


@register("feature_state_coordinates", S.with_fixture(S.SPLIT_SQL, SF.state_ctes()) + "\n" + S.rounded(
    "SELECT * FROM fs_coords", ["lat", "lon"], ["city"]))
def q_feature_state_coordinates(spark, sf):
    """Median coordinates per city over stacked pickup and delivery rows."""
    return round_doubles(fitted_state(spark, sf).coordinates)


@register("feature_state_medians", S.with_fixture(S.SPLIT_SQL, SF.state_ctes()) + "\n" + S.rounded(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS median, (SELECT d FROM fs_ref)"
                       f" AS reference_date, (SELECT count(*) FROM training) AS training_rows FROM fs_clean"
                       for c in K.RAW_NUMERIC), ["median"], ['"column"', "reference_date", "training_rows"]))
def q_feature_state_medians(spark, sf):
    """Reference date and exact medians of the cleaned raw numerics (training rows only)."""
    from ..functions.clean import base_clean
    from ..operators.quantiles import exact_quantiles
    base = base_clean(context(spark, sf).training)
    long = base.select(F.explode(F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).alias("value")) for k in K.RAW_NUMERIC])).alias("kv")).select("kv.*")
    head = C.one_row(base.agg(F.min("date").alias("d"), F.count(F.lit(1)).alias("n")))
    return round_doubles(exact_quantiles(long, ["column"], "value", [0.5], ["median"]).select(
        "column", "median", head.getField("d").alias("reference_date"), head.getField("n").alias("training_rows")))


@register("holdout_features", S.with_fixture(S.SPLIT_SQL, SF.state_ctes(), SF.transform_ctes("holdout", True))
          + "\n" + S.rounded(f"SELECT load_id, {', '.join(ALL_FEATURES)} FROM feat", _FEATURE_DOUBLES,
                             ["load_id"] + [c for c in ALL_FEATURES if c not in _FEATURE_DOUBLES]))
def q_holdout_features(spark, sf):
    """E3-E5/E9/J1/J2/P2-P14 + date, geographic, interaction features of the holdout, state fitted on training."""
    c = context(spark, sf)
    out = FE.transform(fitted_state(spark, sf), c.holdout, ALL_FEATURES, keep=["load_id"])
    return round_doubles(out)


@register("validation_features", S.with_fixture(SF.state_ctes("development", "fd"),
                                                SF.transform_ctes("validation", False, "fd", "vfeat"))
          + "\n" + S.rounded(f"SELECT load_id, {', '.join(ALL_FEATURES)} FROM vfeat", _FEATURE_DOUBLES,
                             ["load_id"] + [c for c in ALL_FEATURES if c not in _FEATURE_DOUBLES]))
def q_validation_features(spark, sf):
    """Inference transform: validation rows (new cities, unseen routes) with state fitted on all labeled rows."""
    c = context(spark, sf)
    out = FE.transform(fitted_state(spark, sf, "development"), c.validation, ALL_FEATURES, keep=["load_id"])
    return round_doubles(out)


# ---------------------------------------------------------------------------
# Splits, folds, contracts
# ---------------------------------------------------------------------------
from ..operators import contracts as C  # noqa: E402
from ..operators.baselines import scoped_baselines  # noqa: E402
from ..operators.split import fold_scopes, monthly_folds, scope_sizes, split_report  # noqa: E402
from ..functions.clean import base_clean  # noqa: E402
from ..sources.csv_io import read_text_csv, typed_loads  # noqa: E402
from ..sources.sinks import fingerprint, output_dir, write_table  # noqa: E402

_SPLIT_REPORT_SQL = """SELECT '{label}' AS split, (SELECT cutoff FROM {cut}) AS cutoff, {horizon} AS horizon_days,
  (SELECT min(date) FROM {tr}) AS training_date_start, (SELECT max(date) FROM {tr}) AS training_date_end,
  (SELECT count(*) FROM {tr}) AS training_rows,
  (SELECT min(date) FROM {ho}) AS holdout_date_start, (SELECT max(date) FROM {ho}) AS holdout_date_end,
  (SELECT count(*) FROM {ho}) AS holdout_rows,
  (SELECT count(*) FROM {ho} WHERE pickup || ' > ' || delivery NOT IN (SELECT pickup || ' > ' || delivery FROM {tr}))
     AS holdout_unseen_route_rows,
  (SELECT count(*) FROM {ho} WHERE pickup NOT IN (SELECT pickup FROM {tr} UNION SELECT delivery FROM {tr})
                                OR delivery NOT IN (SELECT pickup FROM {tr} UNION SELECT delivery FROM {tr}))
     AS holdout_unseen_city_rows"""


@register("outer_split", S.with_fixture(S.SPLIT_SQL) + "\n" + _SPLIT_REPORT_SQL.format(
    label="outer", cut="cut", tr="training", ho="holdout",
    horizon="CAST((SELECT datediff('day', min(date), max(date)) FROM validation) + 1 AS INTEGER)"))
def q_outer_split(spark, sf):
    """Horizon-matched chronological split and its report."""
    c = context(spark, sf)
    return split_report(c.development, c.outer)


@register("inner_split", S.with_fixture(S.SPLIT_SQL, S.INNER_SQL) + "\n" + _SPLIT_REPORT_SQL.format(
    label="inner", cut="icut", tr="inner_training", ho="inner_validation", horizon=str(K.INNER_HORIZON_DAYS)))
def q_inner_split(spark, sf):
    """training-only 61-day tail split and its report."""
    c = context(spark, sf)
    return split_report(c.training, c.inner)


_FOLDS_SQL = f"""fm AS (SELECT CAST(date_trunc('month', max(date)) AS DATE) AS m FROM development),
folds AS (SELECT strftime(CAST(f AS DATE), '%Y-%m') AS fold_month, CAST(f AS DATE) AS ms, last_day(CAST(f AS DATE)) AS me
          FROM generate_series(CAST((SELECT m FROM fm) - INTERVAL {K.STABILITY_FOLDS - 1} MONTH AS TIMESTAMP),
                               CAST((SELECT m FROM fm) AS TIMESTAMP), INTERVAL 1 MONTH) AS t(f))"""


@register("stability_folds", S.with_fixture(_FOLDS_SQL) + """
SELECT fold_month, ms AS month_start, me AS month_end,
  (SELECT count(*) FROM development d WHERE d.date < f.ms) AS training_rows,
  (SELECT count(*) FROM development d WHERE d.date BETWEEN f.ms AND f.me) AS holdout_rows FROM folds f""")
def q_stability_folds(spark, sf):
    """expanding monthly folds over the last three labeled months and their sizes."""
    c = context(spark, sf)
    folds = monthly_folds(c.development)
    sizes = scope_sizes(c.development, fold_scopes(folds)).withColumnRenamed("scope", "fold_month")
    return folds.join(F.broadcast(sizes), "fold_month").select("fold_month", "month_start", "month_end", "training_rows", "holdout_rows")


_TEMPLATE_SQL = "template AS (SELECT load_id, row_number() OVER (ORDER BY date, load_id) AS ordinal FROM validation)"

_INPUT_CONTRACTS_SQL = f"""SELECT * FROM (VALUES ('C1_single_target_column', 0), ('C2_required_columns_missing', 0),
  ('C3_feature_schema_mismatch', 0), ('C4_template_columns', 0)) AS t("check", violations)
UNION ALL SELECT 'C5_template_row_difference', abs((SELECT count(*) FROM template) - (SELECT count(*) FROM validation))
UNION ALL SELECT 'C6_template_id_mismatch',
  (SELECT count(*) FROM (SELECT DISTINCT load_id FROM template EXCEPT SELECT DISTINCT load_id FROM validation))
  + (SELECT count(*) FROM (SELECT DISTINCT load_id FROM validation EXCEPT SELECT DISTINCT load_id FROM template))
UNION ALL SELECT 'C7_development_id_null_or_duplicate', (SELECT count_if(load_id IS NULL) + count(*) - count(DISTINCT load_id)
  - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END) FROM development)
UNION ALL SELECT 'C7_validation_id_null_or_duplicate', (SELECT count_if(load_id IS NULL) + count(*) - count(DISTINCT load_id)
  - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END) FROM validation)
UNION ALL SELECT 'C8_development_invalid_dates', (SELECT count_if(date IS NULL) FROM development)
UNION ALL SELECT 'C8_validation_invalid_dates', (SELECT count_if(date IS NULL) FROM validation)
UNION ALL SELECT 'C9_target_invalid', (SELECT count_if(posted_rate IS NULL OR isnan(posted_rate) OR isinf(posted_rate)
  OR posted_rate <= 0) FROM development)"""


@register("input_contracts", S.with_fixture(_TEMPLATE_SQL) + "\nSELECT \"check\", CAST(violations AS BIGINT) AS violations"
          " FROM (" + _INPUT_CONTRACTS_SQL + ") q")
def q_input_contracts(spark, sf):
    """Target discovery, schemas, template shape and ids, id uniqueness, dates, target validity."""
    c = context(spark, sf)
    return C.input_contracts(c.development, c.validation, fixture.template(spark, sf))


@register("split_contracts", S.with_fixture(S.SPLIT_SQL, S.INNER_SQL) + f"""
SELECT 'C17_inner_overlaps_holdout' AS "check", CAST(coalesce((SELECT max(date) FROM inner_validation)
   >= (SELECT min(date) FROM holdout), false) AS BIGINT) AS violations
UNION ALL SELECT 'C22_parts_below_minimum', CAST(((SELECT count(*) FROM training) < {100})::INT
  + ((SELECT count(*) FROM holdout) < {100})::INT + ((SELECT count(*) FROM inner_training) < {100})::INT
  + ((SELECT count(*) FROM inner_validation) < {100})::INT AS BIGINT)""")
def q_split_contracts(spark, sf):
    """Inner validation precedes the outer holdout; every split part has the minimum rows."""
    from .context import FIXTURE_MIN_ROWS
    c = context(spark, sf)
    return C.split_contracts(c.training, c.holdout, c.inner_training, c.inner_validation, FIXTURE_MIN_ROWS)


# Baseline leaderboard over the outer holdout and every stability fold, in one job.
_BOARD_SQL = f"""btrain AS (SELECT 'outer_holdout' AS scope, * FROM training
                UNION ALL SELECT f.fold_month, d.* FROM development d JOIN folds f ON d.date < f.ms),
bhold AS (SELECT 'outer_holdout' AS scope, * FROM holdout
          UNION ALL SELECT f.fold_month, d.* FROM development d JOIN folds f ON d.date BETWEEN f.ms AND f.me),
gmed AS (SELECT scope, quantile_cont(posted_rate, 0.5) AS m FROM btrain GROUP BY scope),
btr AS (SELECT scope, {S.norm('equipment')} AS g, posted_rate / distance AS rpm FROM btrain),
bgm AS (SELECT scope, g, quantile_cont(rpm, 0.5) AS m FROM btr GROUP BY scope, g),
bfb AS (SELECT scope, quantile_cont(rpm, 0.5) AS f FROM btr GROUP BY scope),
blong AS (
  SELECT h.scope, 'global_median' AS model, 'Baseline' AS model_family, 'target_only' AS feature_set,
         h.posted_rate AS actual, g.m AS predicted FROM bhold h JOIN gmed g ON h.scope = g.scope
  UNION ALL
  SELECT h.scope, 'equipment_median_rpm', 'Baseline', 'distance + equipment', h.posted_rate,
         coalesce(bgm.m, bfb.f) * h.distance FROM bhold h
         LEFT JOIN bgm ON h.scope = bgm.scope AND {S.norm('h.equipment')} = bgm.g LEFT JOIN bfb ON h.scope = bfb.scope),
board AS (SELECT scope, model, model_family, feature_set, '{{}}' AS parameters, false AS eligible, {S.metrics(bias=False)} FROM blong GROUP BY scope, model, model_family, feature_set)"""


def baseline_board(spark, sf):
    from ..operators.selection import leaderboard
    c = context(spark, sf)
    rows = scoped_baselines(c.development, c.baseline_scopes)
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(fs).alias("feature_set"), F.col(p).alias("predicted")) for m, fs, p in [
        ("global_median", "target_only", "global_median"), ("equipment_median_rpm", "distance + equipment", "group_median")]])
    long = rows.select("scope", F.col(K.TARGET).alias("actual"), F.explode(models).alias("m")).select(
        "scope", "actual", "m.*", F.lit(K.BASELINE_FAMILY).alias("model_family"), F.lit("{}").alias("parameters"), F.lit(False).alias("eligible"))
    return leaderboard(long, ["scope"])


@register("baseline_leaderboard", S.with_fixture(S.SPLIT_SQL, _FOLDS_SQL, _BOARD_SQL) + "\n" + S.rounded(
    "SELECT *, CAST(row_number() OVER (PARTITION BY scope ORDER BY mae, model) AS INTEGER) AS rank,"
    " false AS selected, CAST(NULL AS VARCHAR) AS signature FROM board",
    ["mae", "rmse", "r2", "smape"],
    ["scope", "model", "model_family", "feature_set", "parameters", "eligible", "rows", "rank",
     "selected", "signature"]))
def q_baseline_leaderboard(spark, sf):
    """Both baselines on the outer holdout and each stability fold, ranked."""
    return round_doubles(baseline_board(spark, sf))


@register("baseline_contracts", S.with_fixture(S.SPLIT_SQL, _FOLDS_SQL, _BOARD_SQL) + """
SELECT 'C23_baseline_eligible_or_selected' AS "check", CAST(count_if(eligible) AS BIGINT) AS violations FROM board
UNION ALL SELECT 'C23_baseline_count', CAST((SELECT count(*) FROM (SELECT scope FROM board GROUP BY scope
  HAVING count(*) <> 2)) AS BIGINT)""")
def q_baseline_contracts(spark, sf):
    """Each baseline appears once per scope, ineligible and unselected."""
    from ..operators.selection import selection_contract
    checks = selection_contract(baseline_board(spark, sf), ["scope"],
                                baselines=["global_median", "equipment_median_rpm"])
    return checks.where(F.col("check").startswith("C23"))


_PRED_SQL = f"""ftr AS (SELECT {S.norm('equipment')} AS g, posted_rate / distance AS rpm FROM development),
fgm AS (SELECT g, quantile_cont(rpm, 0.5) AS m FROM ftr GROUP BY g),
vpred AS (SELECT v.load_id, coalesce(fgm.m, (SELECT quantile_cont(rpm, 0.5) FROM ftr)) * v.distance AS predicted_rate
          FROM validation v LEFT JOIN fgm ON {S.norm('v.equipment')} = fgm.g),
output AS (SELECT t.load_id, p.predicted_rate, t.ordinal FROM template t LEFT JOIN vpred p USING (load_id))"""


@register("prediction_contract", S.with_fixture(_TEMPLATE_SQL, _PRED_SQL) + """
SELECT 'C11_columns' AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'C11_row_difference', abs((SELECT count(*) FROM output) - (SELECT count(*) FROM template))
UNION ALL SELECT 'C11_id_null_or_duplicate', (SELECT count_if(load_id IS NULL) + count(*) - count(DISTINCT load_id)
  - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END) FROM output)
UNION ALL SELECT 'C11_template_order_changed', (SELECT count(*) FROM output o FULL JOIN template t USING (ordinal)
  WHERE o.load_id IS DISTINCT FROM t.load_id OR o.load_id IS NULL)
UNION ALL SELECT 'C13_id_set_mismatch',
  (SELECT count(*) FROM (SELECT DISTINCT load_id FROM output EXCEPT SELECT DISTINCT load_id FROM validation))
  + (SELECT count(*) FROM (SELECT DISTINCT load_id FROM validation EXCEPT SELECT DISTINCT load_id FROM output))
UNION ALL SELECT 'C12_prediction_not_finite_positive', (SELECT count_if(predicted_rate IS NULL OR isnan(predicted_rate)
  OR isinf(predicted_rate) OR predicted_rate <= 0) FROM output)""")
def q_prediction_contract(spark, sf):
    """Score validation (group-median baseline), keep template order, write, re-read, check."""
    c = context(spark, sf)
    tmpl = fixture.template(spark, sf)
    pred = group_median_rpm(c.development, c.validation).select("load_id", F.col("predicted").alias(K.PREDICTION))
    out = tmpl.select("load_id", "ordinal").join(pred, "load_id", "left").select("load_id", K.PREDICTION, "ordinal")
    back = write_table(out, output_dir(spark, "validation_predictions"))
    return C.prediction_contract(back, tmpl, c.validation)


_SCEN_PRED_SQL = f"""ftr AS (SELECT {S.norm('equipment')} AS g, posted_rate / distance AS rpm FROM development),
fgm AS (SELECT g, quantile_cont(rpm, 0.5) AS m FROM ftr GROUP BY g),
spred AS (SELECT s.*, coalesce(fgm.m, (SELECT quantile_cont(rpm, 0.5) FROM ftr)) * s.distance AS predicted_rate
          FROM scenario s LEFT JOIN fgm ON s.equipment = fgm.g)"""


@register("scenario_contract", S.with_fixture(S.SCENARIO_SQL, _SCEN_PRED_SQL) + """
SELECT 'C10_columns' AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'C10_fixed_inputs_changed', 0
UNION ALL SELECT 'C14_missing_days', (SELECT count(*) FROM generate_series(CAST((SELECT m FROM smonth) AS TIMESTAMP),
   CAST(last_day((SELECT m FROM smonth)) AS TIMESTAMP), INTERVAL 1 DAY) t(d) WHERE CAST(d AS DATE) NOT IN (SELECT date FROM spred))
UNION ALL SELECT 'C14_extra_or_duplicate_days', (SELECT count(*) - count(DISTINCT date) FROM spred)
   + (SELECT count(*) FROM spred WHERE date < (SELECT m FROM smonth) OR date > last_day((SELECT m FROM smonth)))
UNION ALL SELECT 'C10_prediction_not_finite_positive', (SELECT count_if(predicted_rate IS NULL OR isnan(predicted_rate)
   OR isinf(predicted_rate) OR predicted_rate <= 0) FROM spred)
UNION ALL SELECT 'C10_dates_out_of_order', 0""")
def q_scenario_contract(spark, sf):
    """C10/C14/S2/M13(baseline): the grid written and read as a 6-column CSV, scored and checked against the labeled data."""
    c = context(spark, sf)
    path = output_dir(spark, "scenario_csv")
    fixture.scenario(spark, sf).orderBy("date").write.option("header", True).csv(path)
    grid = typed_loads(read_text_csv(spark, path, K.SCENARIO_COLUMNS), numeric=["distance", "weight"])
    expected = fixture.scenario_inputs(spark, sf).first().asDict()   # the documented inputs: one row
    expected["month"] = str(expected["month"])
    scored = group_median_rpm(c.development, grid).withColumnRenamed("predicted", K.PREDICTION)
    first = scored.agg(F.min("date")).scalar()
    scored = scored.withColumn("ordinal", F.datediff("date", first) + 1)
    return C.scenario_contract(scored.select(*K.SCENARIO_COLUMNS, K.PREDICTION, "ordinal"), expected, ordered=True)


def _fp_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        if c in _DOUBLE_COLS:
            parts.append(f"coalesce(CAST(TRY_CAST(round({c} * 1000000E0) AS BIGINT) AS VARCHAR), '~N')")
        else:
            parts.append(f"coalesce(CAST({c} AS VARCHAR), '~N')")
    h = f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT)"
    return (f"SELECT '{table}' AS \"table\", count(*) AS rows, CAST(sum({h} % 1000003) AS BIGINT) AS hash_sum,"
            f" bit_xor({h}) AS hash_xor FROM {table}")


@register("table_fingerprint", S.with_fixture() + "\n" + " UNION ALL ".join(
    [_fp_sql("development", _DEV_COLS), _fp_sql("validation", K.LOAD_COLUMNS)]))
def q_table_fingerprint(spark, sf):
    """Content fingerprint of each input table (replaces file hashes; order-insensitive)."""
    c = context(spark, sf)
    return fingerprint(c.development, "development").unionByName(fingerprint(c.validation, "validation"))


# ---------------------------------------------------------------------------
# CSV sources and prediction summary (S1, S3, P2-P10 on text input, A23)
# ---------------------------------------------------------------------------
_CLEAN_DOUBLES = ["distance", "weight", "market_index", "quote_signal", "pickup_lat", "delivery_lat",
                  "pickup_lon", "delivery_lon"]


@register("csv_roundtrip_clean", S.with_fixture() + "\n" + S.rounded(
    SF.clean_select("validation", with_target=False), _CLEAN_DOUBLES,
    ["load_id", "date", "pickup", "delivery", "equipment", "weight_missing", "weight_sign_corrected",
     "market_index_missing"]))
def q_csv_roundtrip_clean(spark, sf):
    """Write the future table as CSV, read it back as text, type and clean it."""
    c = context(spark, sf)
    path = output_dir(spark, "validation_csv")
    c.validation.write.option("header", True).csv(path)
    typed = typed_loads(read_text_csv(spark, path, c.validation.columns))
    return round_doubles(base_clean(typed))


@register("prediction_summary", S.with_fixture(_TEMPLATE_SQL, _PRED_SQL) + "\n" + S.rounded(
    "SELECT count(*) AS rows, min(predicted_rate) AS min, avg(predicted_rate) AS mean, max(predicted_rate) AS max"
    " FROM output", ["min", "mean", "max"], ["rows"]))
def q_prediction_summary(spark, sf):
    """Rows / min / mean / max of the future-table predictions (group-median baseline)."""
    c = context(spark, sf)
    pred = group_median_rpm(c.development, c.validation).select("load_id", F.col("predicted").alias(K.PREDICTION))
    out = fixture.template(spark, sf).select("load_id").join(pred, "load_id", "left")
    return round_doubles(out.agg(F.count(F.lit(1)).alias("rows"), F.min(K.PREDICTION).alias("min"),
                                 F.avg(K.PREDICTION).alias("mean"), F.max(K.PREDICTION).alias("max")))


# ---------------------------------------------------------------------------
# The same audit operators on an independent schema: the events table
# ---------------------------------------------------------------------------
from ..sources.tables import read_table  # noqa: E402


@register("events_monthly_value", S.rounded(
    "SELECT strftime(CAST(ts AS DATE), '%Y-%m') AS month, avg(value) AS mean, quantile_cont(value, 0.5) AS median"
    " FROM events GROUP BY 1", ["mean", "median"], ["month"]))
def q_events_monthly_value(spark, sf):
    """A17 on events: monthly mean and exact median of ``value`` (timestamps cast to dates)."""
    ev = read_table(spark, sf, "events").select("ts", "value")
    return round_doubles(A.monthly_target(ev, "value", "ts"))


@register("events_numeric_summary", S.rounded(
    "SELECT event_type AS dataset, 'value' AS \"column\", count(value) AS count, avg(value) AS mean,"
    " stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.5) AS median,"
    " quantile_cont(value, 0.95) AS p95, max(value) AS max, count_if(value IS NULL) AS missing,"
    " count_if(value <= 0) AS non_positive FROM events GROUP BY event_type",
    ["mean", "std", "min", "median", "p95", "max"], ["dataset", '"column"', "count", "missing", "non_positive"]))
def q_events_numeric_summary(spark, sf):
    """A2 on events: per event type, count / mean / std / quantiles / missing / non-positive of ``value``."""
    ev = read_table(spark, sf, "events")
    long = ev.select(F.col("event_type").alias("dataset"), F.lit("value").alias("column"),
                     F.col("value").alias("v"), F.col("value").alias("raw"))
    return round_doubles(A.numeric_summary_long(long))
