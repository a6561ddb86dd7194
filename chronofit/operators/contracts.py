"""Contracts (C1-C25, U5): predicates over tables returned as (check, violations) rows.

Every table involved is aggregated ONCE (one pass computing all its conditional
counts, exposed as a struct-valued scalar subquery that Spark evaluates once and
reuses); the checks form one wide row that ``unpivot`` turns into (check, violations).
Set differences are one full outer join of distinct keys.  Metadata checks (column
lists and order) are evaluated on the schema.  ``enforce`` is the strict mode.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.clean import to_date, to_double

REQUIRED_COLUMNS = K.LOAD_COLUMNS


def one_row(df: DataFrame) -> Column:
    """A one-row aggregate as a struct scalar subquery (computed once, fields reused)."""
    return df.select(F.struct(*df.columns).alias("s")).scalar()


def checks_table(spark: SparkSession, checks: dict[str, Column | int]) -> DataFrame:
    """One wide row of violation counts -> (check, violations) rows, in the given order."""
    cols = [(v if isinstance(v, Column) else F.lit(int(v))).cast("long").alias(k) for k, v in checks.items()]
    wide = spark.range(1).select(*cols)
    return wide.unpivot([], list(checks), "check", "violations")


def union_checks(rows: Sequence[DataFrame]) -> DataFrame:
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def enforce(checks: DataFrame) -> DataFrame:
    """Strict mode: raise when any check has violations (collects one row per check)."""
    bad = [(r["check"], r["violations"]) for r in checks.where(F.col("violations") > 0).collect()]
    if bad:
        raise ValueError(f"Contract violations: {bad}")
    return checks


def _text_type(df: DataFrame, col: str):
    return T.StringType() if dict(df.dtypes)[col] == "string" else None


def bad_positive(x: Column) -> Column:
    """Missing, non-numeric, NaN, infinite or <= 0."""
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))) | (x <= 0)


def table_stats(df: DataFrame, id_col: str | None = K.ID, date_col: str | None = "date",
                positive_col: str | None = None) -> Column:
    """One pass: rows, NULL/duplicate ids, unparsable dates, non-positive values."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if id_col:
        has_null = F.max(F.col(id_col).isNull().cast("int"))
        aggs.append((F.count_if(F.col(id_col).isNull()) + F.count(F.lit(1)) - F.count_distinct(id_col)
                     - has_null).alias("bad_ids"))
    if date_col:
        aggs.append(F.count_if(to_date(date_col, _text_type(df, date_col)).isNull()).alias("bad_dates"))
    if positive_col:
        aggs.append(F.count_if(bad_positive(to_double(positive_col, _text_type(df, positive_col))))
                    .alias("bad_values"))
    return one_row(df.agg(*aggs))


def set_difference_count(left: DataFrame, right: DataFrame, key: str = K.ID) -> Column:
    """|left - right| + |right - left| over distinct keys, one full outer join."""
    a = left.select(key).distinct().withColumn("__l", F.lit(1))
    b = right.select(key).distinct().withColumn("__r", F.lit(1))
    return a.join(b, key, "full_outer").agg(
        F.count_if(F.col("__l").isNull() | F.col("__r").isNull())).scalar()


def input_contracts(development: DataFrame, validation: DataFrame, template: DataFrame,
                    target: str | None = None) -> DataFrame:
    """C1-C9 over the labeled table, the future table and the output template."""
    extra = [c for c in development.columns if c not in validation.columns]
    tgt = target or (extra[0] if len(extra) == 1 else K.TARGET)
    d = table_stats(development, positive_col=tgt)
    v = table_stats(validation)
    t = table_stats(template, date_col=None)
    return checks_table(development.sparkSession, {
        "C1_single_target_column": 0 if len(extra) == 1 else 1,
        "C2_required_columns_missing": len([c for c in REQUIRED_COLUMNS if c not in development.columns])
        + len([c for c in REQUIRED_COLUMNS if c not in validation.columns]),
        "C3_feature_schema_mismatch": 0 if set(development.columns) - {tgt} == set(validation.columns) else 1,
        "C4_template_columns": 0 if [c for c in template.columns if c != "ordinal"] == [K.ID, K.PREDICTION] else 1,
        "C5_template_row_difference": F.abs(t.getField("rows") - v.getField("rows")),
        "C6_template_id_mismatch": set_difference_count(template, validation),
        "C7_development_id_null_or_duplicate": d.getField("bad_ids"),
        "C7_validation_id_null_or_duplicate": v.getField("bad_ids"),
        "C8_development_invalid_dates": d.getField("bad_dates"),
        "C8_validation_invalid_dates": v.getField("bad_dates"),
        "C9_target_invalid": d.getField("bad_values"),
    })


def split_contracts(outer_training: DataFrame, holdout: DataFrame, inner_training: DataFrame,
                    inner_validation: DataFrame, min_rows: int = K.MIN_SPLIT_ROWS) -> DataFrame:
    """C17 (inner validation ends before the holdout starts) and C22 (minimum part sizes)."""
    parts = [one_row(p.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("d0"), F.max("date").alias("d1")))
             for p in [outer_training, holdout, inner_training, inner_validation]]
    small = sum(((p.getField("n") < min_rows).cast("int") for p in parts), F.lit(0))
    overlap = F.coalesce((parts[3].getField("d1") >= parts[1].getField("d0")).cast("int"), F.lit(0))
    return checks_table(outer_training.sparkSession, {
        "C17_inner_overlaps_holdout": overlap, "C22_parts_below_minimum": small})


def prediction_contract(output: DataFrame, template: DataFrame, validation: DataFrame) -> DataFrame:
    """Exact columns, row count, unique ids, template order, id set, finite > 0.

    ``output`` carries ``ordinal`` (row order is not a table property); order is kept when
    the id at each ordinal equals the template's id at that ordinal.
    """
    cols = [c for c in output.columns if c != "ordinal"]
    o = table_stats(output, date_col=None, positive_col=K.PREDICTION)
    t = table_stats(template, date_col=None)
    moved = (output.select(F.col(K.ID).alias("oid"), "ordinal")
             .join(template.select(F.col(K.ID).alias("tid"), "ordinal"), "ordinal", "full_outer")
             .agg(F.count_if(~F.coalesce(F.col("oid") == F.col("tid"), F.lit(False)))).scalar())
    return checks_table(output.sparkSession, {
        "C11_columns": 0 if cols == [K.ID, K.PREDICTION] else 1,
        "C11_row_difference": F.abs(o.getField("rows") - t.getField("rows")),
        "C11_id_null_or_duplicate": o.getField("bad_ids"),
        "C11_template_order_changed": moved,
        "C13_id_set_mismatch": set_difference_count(output, validation),
        "C12_prediction_not_finite_positive": o.getField("bad_values"),
    })


def scenario_contract(scenario: DataFrame, expected: dict, ordered: bool = False,
                      columns: Sequence[str] = tuple(K.SCENARIO_COLUMNS + [K.PREDICTION]),
                      rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Fixed inputs, one row per day of the month, positive finite predictions.

    ``expected`` holds pickup, delivery, equipment, distance, weight and month (first day).
    ``ordered`` additionally requires rows in date order (needs an ``ordinal`` column).
    """
    spark = scenario.sparkSession
    month = F.lit(expected["month"]).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(month, F.last_day(month), F.expr("INTERVAL 1 DAY")))
                                 .alias("date")).withColumn("__g", F.lit(1))
    d = scenario.select(F.col("date").cast("date").alias("date")).withColumn("__s", F.lit(1))

    def close(c: str) -> Column:
        b = F.lit(float(expected[c]))
        return F.coalesce(F.abs(to_double(c) - b) <= atol + rtol * F.abs(b), F.lit(False))

    aggs = [F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("days"),
            (sum((F.count_if(~F.col(c).eqNullSafe(F.lit(expected[c]))) for c in ("pickup", "delivery", "equipment")), F.lit(0))
             + F.count_if(~close("distance"))
             + F.count_if(~close("weight"))).alias("fixed"),
            F.count_if(bad_positive(to_double(K.PREDICTION))).alias("bad_pred")]
    if ordered:
        aggs.append(F.count_if(~F.col("ordinal").eqNullSafe(F.datediff(F.col("date").cast("date"), month) + 1))
                    .alias("moved"))
    s = one_row(scenario.agg(*aggs))
    grid = one_row(days.join(d.groupBy("date").agg(F.sum("__s").alias("__s")), "date", "full_outer").agg(
        F.count_if(F.col("__s").isNull()).alias("missing"), F.count_if(F.col("__g").isNull()).alias("extra")))
    checks = {
        "C10_columns": 0 if [c for c in scenario.columns if c != "ordinal"] == list(columns) else 1,
        "C10_fixed_inputs_changed": s.getField("fixed"),
        "C14_missing_days": grid.getField("missing"),
        "C14_extra_or_duplicate_days": s.getField("rows") - s.getField("days") + grid.getField("extra"),
        "C10_prediction_not_finite_positive": s.getField("bad_pred"),
    }
    if ordered:
        checks["C10_dates_out_of_order"] = s.getField("moved")
    return checks_table(spark, checks)
