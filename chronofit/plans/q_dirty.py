"""SQL-checked queries on tables that break the rules: cleaning, fills and contracts (P8-P13, E7, E8, J1, C1-C9, holidays)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.features import date_features
from ..functions.metrics import round_doubles
from ..operators import contracts as C
from ..operators import features as FE
from ..sources import fixture
from . import sql as S
from . import sql_features as SF
from .catalog import register
from .context import context

_KIND = "CAST(split_part(load_id, '-', 1) AS BIGINT) % 20"
#: Column -> {kind of order number: what stands there instead}.
_VALUES = {"pickup_lat": {7: "95E0", 9: "NULL"}, "delivery_lon": {8: "-200E0", 9: "NULL"}, "pickup": {10: "NULL"}, "equipment": {11: "'  '"},
           "distance": {12: "-5E0"}, "market_index": {14: "0E0"}}
_RECORDS = {"load_id": {1: "NULL", 2: "'TWICE'"}, "date": {3: "'2001/01/05'", 4: "'soon'"}, "posted_rate": {5: "NULL", 6: "-5E0", 13: "CAST('inf' AS DOUBLE)"}}


def _swapped(changes: dict, columns: list[str]) -> list[str]:
    """SQL columns (for either engine) with the planted values."""
    out = []
    for c in columns:
        old = f"CAST({c} AS STRING)" if c == "date" and "date" in changes else c
        cases = " ".join(f"WHEN {k} THEN {v}" for k, v in changes.get(c, {}).items())
        out.append(f"CASE {_KIND} {cases} ELSE {old} END AS {c}" if cases else old)
    return out


_COLS = K.LOAD_COLUMNS + [K.TARGET]
_DIRTY_SQL = f"""dirty AS (SELECT {', '.join(_swapped(_VALUES, _COLS))} FROM development),
dtrain AS (SELECT * FROM dirty WHERE date < (SELECT cutoff FROM cut)), dhold AS (SELECT * FROM dirty WHERE date >= (SELECT cutoff FROM cut))"""
_FILLED = {"pickup_lat": "p.lat", "pickup_lon": "p.lon", "delivery_lat": "q.lat", "delivery_lon": "q.lon"}


@register("dirty_features", S.with_fixture(S.SPLIT_SQL, _DIRTY_SQL, SF.state_ctes("dtrain", "ds"), f"dclean AS ({SF.clean_select('dhold', False)})") + "\n" + S.rounded(
    "SELECT load_id, pickup, delivery, equipment, weight_missing, market_index_missing, " + ", ".join(
        f"coalesce(h.{c}, {_FILLED.get(c, 'NULL')}, (SELECT quantile_cont({c}, 0.5) FROM ds_clean)) AS {c}" for c in K.RAW_NUMERIC)
    + " FROM dclean h LEFT JOIN ds_coords p ON h.pickup = p.city LEFT JOIN ds_coords q ON h.delivery = q.city",
    list(K.RAW_NUMERIC), ["load_id", "pickup", "delivery", "equipment", "weight_missing", "market_index_missing"]))
def q_dirty_features(spark, sf):
    """Out-of-range and missing coordinates filled by city, the rest by medians; missing categories named."""
    c = context(spark, sf)
    dirty = c.development.selectExpr(*_swapped(_VALUES, _COLS))
    state = FE.fit(c.outer.training(dirty), impute_numeric=True)
    features = ["pickup", "delivery", "equipment", "weight_missing", "market_index_missing", *K.RAW_NUMERIC]
    return round_doubles(FE.transform(state, c.outer.holdout(dirty), features, keep=["load_id"]))


_IDS = "count_if(load_id IS NULL) + count(*) - count(DISTINCT load_id) - max(CASE WHEN load_id IS NULL THEN 1 ELSE 0 END)"
_BROKEN_SQL = f"""broken AS (SELECT {', '.join(_swapped(_RECORDS, _COLS)).replace('STRING', 'VARCHAR')} FROM development),
tmpl AS (SELECT load_id, row_number() OVER (ORDER BY date, load_id) AS ordinal FROM validation)"""


@register("broken_input_contracts", S.with_fixture(_BROKEN_SQL) + f"""
SELECT * FROM (VALUES ('C1_single_target_column', CAST(1 AS BIGINT)), ('C2_required_columns_missing', 1), ('C3_feature_schema_mismatch', 1),
  ('C4_template_columns', 1)) AS t("check", violations)
UNION ALL SELECT 'C5_template_row_difference', (SELECT count(*) FROM tmpl WHERE ordinal % 7 = 0)
UNION ALL SELECT 'C6_template_id_mismatch', (SELECT count(*) FROM tmpl WHERE ordinal % 7 = 0)
UNION ALL SELECT 'C7_development_id_null_or_duplicate', (SELECT {_IDS} FROM broken)
UNION ALL SELECT 'C7_validation_id_null_or_duplicate', 0
UNION ALL SELECT 'C8_development_invalid_dates', (SELECT count_if(TRY_CAST(CASE WHEN regexp_full_match(date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN date END AS DATE) IS NULL) FROM broken)
UNION ALL SELECT 'C8_validation_invalid_dates', 0
UNION ALL SELECT 'C9_target_invalid', (SELECT count_if(posted_rate IS NULL OR isinf(posted_rate) OR posted_rate <= 0) FROM broken)""")
def q_broken_input_contracts(spark, sf):
    """C1-C9 on inputs that break them: a column short and one too many, ids null and twice, odd dates, bad targets, a short template."""
    c = context(spark, sf)
    broken = c.development.selectExpr(*_swapped(_RECORDS, _COLS))
    validation = c.validation.drop("weight").withColumn("note", F.lit("x"))
    template = fixture.template(spark, sf).where("ordinal % 7 <> 0").select(K.PREDICTION, K.ID, "ordinal")
    return C.input_contracts(broken, validation, template)


_SHIFT = 26 * 12


@register("holiday_flags", S.with_fixture() + f"""
SELECT CAST(d AS DATE) AS date, CAST(d IN ({', '.join(f"DATE '{h}'" for h in K.FEDERAL_HOLIDAYS)}) AS INTEGER) AS federal_holiday,
  CAST({' OR '.join(f"abs(datediff('day', DATE '{a}', d)) <= {K.NEAR_DATE_DAYS}" for a in K.THANKSGIVING)} AS INTEGER) AS near_thanksgiving,
  CAST({' OR '.join(f"abs(datediff('day', DATE '{a}', d)) <= {K.NEAR_DATE_DAYS}" for a in K.CHRISTMAS)} AS INTEGER) AS near_christmas,
  count(*) AS loads
FROM (SELECT CAST(date + INTERVAL {_SHIFT} MONTH AS DATE) AS d FROM loads WHERE date BETWEEN DATE '1998-12-01' AND DATE '2000-02-28') x GROUP BY d""")
def q_holiday_flags(spark, sf):
    """§2.4 holiday flags where they are not all 0: loads of 1999 moved by 26 years, counted by day."""
    rows = fixture.loads(spark, sf).where(F.col("date").between(F.lit("1998-12-01").cast("date"), F.lit("2000-02-28").cast("date")))
    days = rows.select(F.add_months("date", _SHIFT).alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("loads"))
    flags = date_features(F.col("date"), days.agg(F.min("date")).first()[0])
    return days.select("date", *[flags[f].alias(f) for f in ("federal_holiday", "near_thanksgiving", "near_christmas")], "loads")
