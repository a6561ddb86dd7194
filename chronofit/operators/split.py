"""Chronological splits (F1-F5): horizon-matched outer split, inner tail split, monthly folds.

Split boundaries are scalars from one-row aggregates (like an estimator's fit); the
row filters that use them are plain date predicates, so they push down to the scan
whenever the date column is a stored column.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import to_date
from .contracts import one_row


@dataclass(frozen=True)
class SplitPlan:
    cutoff: _dt.date          # training: date < cutoff <= holdout
    horizon_days: int
    label: str = "outer"

    def training(self, df: DataFrame, date_col: str = "date") -> DataFrame:
        return df.where(F.col(date_col) < F.lit(self.cutoff))

    def holdout(self, df: DataFrame, date_col: str = "date") -> DataFrame:
        return df.where(F.col(date_col) >= F.lit(self.cutoff))


def _dates(df: DataFrame, date_col: str):
    types = dict(df.dtypes)
    from pyspark.sql import types as T
    dtype = T.StringType() if types[date_col] == "string" else None
    return to_date(date_col, dtype)


def outer_split(development: DataFrame, validation: DataFrame, date_col: str = "date",
                min_rows: int = K.MIN_SPLIT_ROWS) -> SplitPlan:
    """horizon = validation day span + 1; cutoff = last labeled day - (horizon - 1)."""
    dev = development.agg(F.max(_dates(development, date_col)).alias("mx")).first()
    val = validation.agg(F.min(_dates(validation, date_col)).alias("mn"),
                         F.max(_dates(validation, date_col)).alias("mx")).first()
    if val["mn"] <= dev["mx"]:
        raise ValueError("Final validation is not strictly later than development")
    horizon = (val["mx"] - val["mn"]).days + 1
    plan = SplitPlan(cutoff=dev["mx"] - _dt.timedelta(days=horizon - 1), horizon_days=horizon)
    _check_sizes(development, plan, date_col, min_rows)
    return plan


def inner_split(outer_training: DataFrame, horizon_days: int = K.INNER_HORIZON_DAYS,
                date_col: str = "date", min_rows: int = K.MIN_SPLIT_ROWS) -> SplitPlan:
    """training-only tail window of ``horizon_days`` days."""
    if horizon_days < 1:
        raise ValueError("horizon must be positive")
    mx = outer_training.agg(F.max(_dates(outer_training, date_col)).alias("mx")).first()["mx"]
    plan = SplitPlan(cutoff=mx - _dt.timedelta(days=horizon_days - 1), horizon_days=horizon_days,
                     label="inner")
    _check_sizes(outer_training, plan, date_col, min_rows)
    return plan


def _check_sizes(df: DataFrame, plan: SplitPlan, date_col: str, min_rows: int) -> None:
    """Both parts need ``min_rows`` rows (one pass, two conditional counts)."""
    d = _dates(df, date_col)
    r = df.agg(F.count_if(d < F.lit(plan.cutoff)).alias("a"),
               F.count_if(d >= F.lit(plan.cutoff)).alias("b")).first()
    if r["a"] < min_rows or r["b"] < min_rows:
        raise ValueError(f"{plan.label} split is too small: {r['a']} / {r['b']} rows (minimum {min_rows})")


def monthly_folds(development: DataFrame, n_folds: int = K.STABILITY_FOLDS,
                  date_col: str = "date") -> DataFrame:
    """expanding-window folds, one per each of the last ``n_folds`` labeled months.

    Returns (fold_month, month_start, month_end); training = date < month_start,
    holdout = month_start <= date <= month_end.  Built from the data, not hard-coded.
    """
    last = development.agg(F.trunc(F.max(_dates(development, date_col)), "month").alias("m"))
    return last.select(F.explode(F.sequence(F.add_months("m", -(n_folds - 1)), F.col("m"),
                                            F.expr("INTERVAL 1 MONTH"))).alias("month_start")) \
        .select(F.date_format("month_start", "yyyy-MM").alias("fold_month"), "month_start",
                F.last_day("month_start").alias("month_end"))


@dataclass(frozen=True)
class Scope:
    """A training window (all days before ``before``) and the holdout days it is judged on."""

    name: str
    before: _dt.date
    start: _dt.date | None = None
    end: _dt.date | None = None


def fold_scopes(folds: DataFrame) -> list[Scope]:
    """The monthly folds as scopes (a few rows)."""
    return [Scope(r["fold_month"], r["month_start"], r["month_start"], r["month_end"]) for r in folds.orderBy("month_start").collect()]


def time_part(scopes: Sequence[Scope], date_col: str = "date") -> Column:
    """The part of the time line a row stands in, from 0: how many of the scopes' bounds its date has reached."""
    part = F.lit(0)
    for b in sorted({s.before for s in scopes}):
        part = part + F.when(F.col(date_col) >= F.lit(b), 1).otherwise(0)
    return part


def training_windows(spark: SparkSession, scopes: Sequence[Scope]) -> DataFrame:
    """``(window, part)``: the parts that each scope's training rows are made of."""
    bounds = sorted({s.before for s in scopes})
    rows = [(s.name, p) for s in scopes for p in range(bounds.index(s.before) + 1)]
    return spark.createDataFrame(rows, "window string, part int")


def holdout_rows(df: DataFrame, scopes: Sequence[Scope], date_col: str = "date") -> DataFrame:
    """``scope`` and the rows of each scope's holdout; a row repeats only in holdouts that overlap."""
    day = F.col(date_col)
    inside = F.array(*[F.when(day.between(F.lit(s.start), F.lit(s.end)), F.lit(s.name)) for s in scopes])
    # most rows are in no holdout: days that a scan can skip, and a condition far cheaper than the array
    df = df.where(reduce(or_, [day.between(F.lit(s.start), F.lit(s.end)) for s in scopes]))
    return df.select(F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("scope"), *df.columns)


def scope_sizes(df: DataFrame, scopes: Sequence[Scope], date_col: str = "date") -> DataFrame:
    """``(scope, training_rows, holdout_rows)`` from one conditional aggregate."""
    day = F.col(date_col)
    counts = df.agg(*[F.struct(F.lit(s.name).alias("scope"), F.count_if(day < F.lit(s.before)).alias("training_rows"),
                               F.count_if(day.between(F.lit(s.start), F.lit(s.end))).alias("holdout_rows")).alias(f"s{i}") for i, s in enumerate(scopes)])
    return counts.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(scopes))])).alias("s")).select("s.*")


def split_report(development: DataFrame, plan: SplitPlan, date_col: str = "date") -> DataFrame:
    """one row with date ranges, row counts and unseen route/city rows of the holdout.

    Unseen routes compare raw ``pickup > delivery`` strings; unseen cities compare each
    holdout pickup and delivery with the union of training pickups and deliveries (J7).
    """
    d = F.col(date_col)
    train = plan.training(development, date_col)
    hold = plan.holdout(development, date_col)
    route = F.concat(F.col("pickup").cast("string"), F.lit(K.ROUTE_SEPARATOR), F.col("delivery").cast("string"))
    train_routes = train.select(route.alias("route")).distinct()
    cities = (train.select(F.col("pickup").cast("string").alias("city"))
              .union(train.select(F.col("delivery").cast("string").alias("city"))).distinct())
    h = hold.select(route.alias("route"), F.col("pickup").cast("string").alias("p"),
                    F.col("delivery").cast("string").alias("q"))
    unseen_route = h.join(train_routes, "route", "left_anti").agg(F.count(F.lit(1))).scalar()
    h2 = (h.join(cities.withColumnRenamed("city", "p").withColumn("__p", F.lit(1)), "p", "left")
          .join(cities.withColumnRenamed("city", "q").withColumn("__q", F.lit(1)), "q", "left"))
    unseen_city = h2.agg(F.count_if(F.col("__p").isNull() | F.col("__q").isNull())).scalar()
    # (the holdout aggregate below and these subqueries each scan the holdout once)
    t = one_row(train.agg(F.min(d).alias("s"), F.max(d).alias("e"), F.count(F.lit(1)).alias("n")))
    return hold.agg(
        F.min(d).alias("holdout_date_start"), F.max(d).alias("holdout_date_end"),
        F.count(F.lit(1)).alias("holdout_rows")).select(
        F.lit(plan.label).alias("split"), F.lit(str(plan.cutoff)).cast("date").alias("cutoff"),
        F.lit(plan.horizon_days).alias("horizon_days"),
        t.getField("s").alias("training_date_start"),
        t.getField("e").alias("training_date_end"),
        t.getField("n").alias("training_rows"),
        "holdout_date_start", "holdout_date_end", "holdout_rows",
        unseen_route.alias("holdout_unseen_route_rows"), unseen_city.alias("holdout_unseen_city_rows"))
