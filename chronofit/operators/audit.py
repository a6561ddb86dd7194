"""Data audit (A1-A17, A25, P18, P25, P26): one-pass aggregates over raw tables.

Per-column statistics are one wide aggregate per table whose single row is unpivoted;
rows are exploded only where values have to be sorted.  Quantiles are
exact and skew-aware (``exact_quantiles``).  Raw values are used as in the original
audit: weight statistics use |weight|, coordinates are checked as given.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.clean import to_date, to_double
from ..functions.features import at_least, haversine
from .contracts import one_row
from .quantiles import exact_quantiles

AUDIT_NUMERICS = ["distance", "weight", "market_index", "quote_signal"]
AUDIT_CATEGORIES = ["pickup", "delivery", "equipment"]


def _long(df: DataFrame, dataset: str, cols: Sequence[str], value) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column"), *value(c)) for c in cols
    ])).alias("kv")).select("kv.*")


def _wide(df: DataFrame, dataset: str, cols: Sequence[str], stats) -> DataFrame:
    """(dataset, column, statistics...): all columns in one aggregate, whose single row is unpivoted."""
    one = df.agg(*[F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column"), *stats(c)).alias(f"__{i}")
                   for i, c in enumerate(cols)])
    return one.select(F.explode(F.array(*[F.col(f"__{i}") for i in range(len(cols))])).alias("kv")).select("kv.*")


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """A1: (dataset, column, missing_count, missing_percent) for every column of every table."""
    parts = []
    for name, df in tables.items():
        def missing(c, df=df):
            col = F.col(c)
            dt = df.schema[c].dataType
            miss = col.isNull() | F.isnan(col) if isinstance(dt, (T.DoubleType, T.FloatType)) else col.isNull()
            return [F.count_if(miss).alias("missing_count"), F.count(F.lit(1)).alias("__n")]
        parts.append(_wide(df, name, df.columns, missing))
    return _stacked(parts).select("dataset", "column", "missing_count",
                                  F.try_divide(F.lit(100.0) * F.col("missing_count"), F.col("__n")).alias("missing_percent"))


def numeric_summary(tables: dict[str, DataFrame], cols: Sequence[str] = AUDIT_NUMERICS) -> DataFrame:
    """A2/P25: count, mean, std, min, median, p95, max (|weight| for weight), missing, non_positive."""
    bases, longs = [], []
    for name, df in tables.items():
        def value(c, df=df):
            raw = to_double(c, df.schema[c].dataType)
            return (F.abs(raw) if c == "weight" else raw), raw
        bases.append(_wide(df, name, cols, lambda c, value=value: _summary_stats(*value(c))))
        longs.append(_long(df, name, cols, lambda c, value=value: [value(c)[0].alias("v")]))
    return _with_quantiles(_stacked(bases), _stacked(longs))


def _summary_stats(v: Column, raw: Column) -> list[Column]:
    return [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
            F.max(v).alias("max"), F.count_if(raw.isNull()).alias("missing"), F.count_if(raw <= 0).alias("non_positive")]


def _with_quantiles(base: DataFrame, long: DataFrame) -> DataFrame:
    q = exact_quantiles(long, ["dataset", "column"], "v", [0.5, 0.95], ["median", "p95"])
    return base.join(q, ["dataset", "column"], "left").select(
        "dataset", "column", "count", "mean", "std", "min", "median", "p95", "max", "missing", "non_positive")


def numeric_summary_long(long: DataFrame) -> DataFrame:
    """A2 over a long table (dataset, column, v = summarised value, raw = value as given)."""
    base = long.groupBy("dataset", "column").agg(*_summary_stats(F.col("v"), F.col("raw")))
    return _with_quantiles(base, long)


def category_shift(development: DataFrame, validation: DataFrame,
                   cols: Sequence[str] = AUDIT_CATEGORIES) -> DataFrame:
    """Uniques on both sides, unseen validation categories (sorted, ' | '-joined)
    and validation rows carrying one.  Two aggregations, no join."""
    both = (_long(development, "development", cols, lambda c: [F.col(c).cast("string").alias("value")])
            .unionByName(_long(validation, "validation", cols, lambda c: [F.col(c).cast("string").alias("value")]))
            .where(F.col("value").isNotNull()))
    per_value = both.groupBy("column", "value").agg(
        F.count_if(F.col("dataset") == "development").alias("dev_n"),
        F.count_if(F.col("dataset") == "validation").alias("val_n"))
    unseen = (F.col("dev_n") == 0) & (F.col("val_n") > 0)
    return per_value.groupBy("column").agg(
        F.count_if(F.col("dev_n") > 0).alias("development_unique"),
        F.count_if(F.col("val_n") > 0).alias("validation_unique"),
        F.count_if(unseen).alias("unseen_categories"),
        F.array_join(F.array_sort(F.collect_list(F.when(unseen, F.col("value")))), K.COMPOSITE_SEPARATOR)
        .alias("unseen_values"),
        F.coalesce(F.sum(F.when(unseen, F.col("val_n"))), F.lit(0)).cast("long").alias("validation_rows_with_unseen"))


def distribution_shift(development: DataFrame, validation: DataFrame,
                       cols: Sequence[str] = AUDIT_NUMERICS, flag: float = K.SHIFT_FLAG_SMD) -> DataFrame:
    """Means, standardised mean difference (pooled sample variance; 0 if pooled <= 0)."""
    def stats(df, side, var):
        def of(c):
            v = to_double(c, df.schema[c].dataType)
            v = F.abs(v) if c == "weight" else v
            return [F.avg(v).alias(side), F.var_samp(v).alias(var)]
        return of
    dev = _wide(development, "development", cols, stats(development, "development_mean", "__vd")).drop("dataset")
    val = _wide(validation, "validation", cols, stats(validation, "validation_mean", "__vv")).drop("dataset")
    agg = dev.join(val, "column")
    pooled = F.sqrt((F.col("__vd") + F.col("__vv")) / 2)
    smd = F.when(pooled > 0, (F.col("validation_mean") - F.col("development_mean")) / pooled).otherwise(F.lit(0.0))
    return agg.select(F.col("column").alias("feature"), "development_mean", "validation_mean",
                      smd.alias("standardized_mean_difference"),
                      (F.abs(smd) >= flag).alias("shift_flagged"))


def target_distribution(development: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Count, mean, std, min, p05, median, p95, p99, max, bias-corrected skew."""
    y = F.col(target)
    n = F.count(y)
    skew = F.skewness(y) * F.sqrt(n * (n - 1)) / (n - 2)
    base = development.agg(n.alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
                           F.min(y).alias("min"), F.max(y).alias("max"), skew.alias("skew"))
    q = one_row(exact_quantiles(development, [], target, [0.05, 0.5, 0.95, 0.99], ["p05", "median", "p95", "p99"]))
    return base.select("count", "mean", "std", "min",
                       *[q.getField(c).alias(c) for c in ["p05", "median", "p95", "p99"]],
                       "max", "skew")


def monthly_target(development: DataFrame, target: str = K.TARGET, date_col: str = "date") -> DataFrame:
    """Mean and median of the target per month (YYYY-MM)."""
    m = development.select(F.date_format(to_date(date_col, development.schema[date_col].dataType), "yyyy-MM")
                           .alias("month"), F.col(target).alias("y"))
    mean = m.groupBy("month").agg(F.avg("y").alias("mean"))
    med = exact_quantiles(m, ["month"], "y", [0.5], ["median"])
    return mean.join(med, "month", "left")


def target_histogram(development: DataFrame, target: str = K.TARGET, bins: int = K.HISTOGRAM_BINS,
                     cap_q: float = K.HISTOGRAM_CAP_QUANTILE) -> DataFrame:
    """Equal-width histogram of the target capped at its 99.5th percentile."""
    cap = exact_quantiles(development, [], target, [cap_q], ["cap"]).select("cap").scalar()
    capped = development.select(F.least(F.col(target), cap).alias("x"))
    rng = one_row(capped.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    lo, hi = rng.getField("lo"), rng.getField("hi")
    width = (hi - lo) / bins
    b = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (capped.select(b.cast("int").alias("bin"), lo.alias("lo"), width.alias("w"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("rows"), F.first("lo").alias("lo"), F.first("w").alias("w"))
            .select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("bin_end"), "rows"))


def route_stats(development: DataFrame, validation: DataFrame, rare_threshold: int = K.RARE_THRESHOLD) -> DataFrame:
    """Unique labeled routes, routes seen < 5 times, validation rows on unseen
    and on rare (1..threshold-1) routes; raw ``pickup > delivery`` strings."""
    def route(df):
        return F.concat(F.col("pickup").cast("string"), F.lit(K.ROUTE_SEPARATOR), F.col("delivery").cast("string"))
    dev = development.select(route(development).alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    val = validation.select(route(validation).alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("vn"))
    joined = val.join(dev, "route", "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    v = one_row(joined.agg(F.coalesce(F.sum(F.when(n == 0, F.col("vn"))), F.lit(0)).cast("long").alias("u"),
                   F.coalesce(F.sum(F.when(n.between(1, rare_threshold - 1), F.col("vn"))), F.lit(0))
                   .cast("long").alias("r")))
    return dev.agg(F.count(F.lit(1)).alias("development_unique"),
                   F.count_if(F.col("n") < 5).alias("frequency_below_5")).select(
        "development_unique", "frequency_below_5", v.getField("u").alias("validation_unseen_rows"),
        v.getField("r").alias("validation_rare_seen_rows"))


def data_audit(development: DataFrame, validation: DataFrame, scenario: DataFrame,
               target: str = K.TARGET) -> DataFrame:
    """One audit row assembled from one-row aggregates (scalar subqueries).

    Duplicate rows/ids count rows equal to an earlier one (NULL equals NULL); invalid
    coordinates count missing values as invalid; the distance/haversine figures use the
    raw coordinates.
    """
    def dates(df):
        return to_date("date", df.schema["date"].dataType)

    def side(df):
        w = to_double("weight", df.schema["weight"].dataType)
        has_null_id = F.max(F.col("load_id").isNull().cast("int"))
        return df.agg(F.count(F.lit(1)).alias("rows"), F.min(dates(df)).alias("d0"), F.max(dates(df)).alias("d1"),
                      F.count_if(dates(df).isNull()).alias("bad_dates"), F.count_if(w < 0).alias("neg_w"),
                      (F.count(F.lit(1)) - F.count_distinct("load_id") - has_null_id).alias("dup_ids"))

    def dup_rows(df):
        return df.agg(F.count(F.lit(1))).scalar() - df.distinct().agg(F.count(F.lit(1))).scalar()

    d, v = one_row(side(development)), one_row(side(validation))
    plat, dlat = F.col("pickup_lat"), F.col("delivery_lat")
    plon, dlon = F.col("pickup_lon"), F.col("delivery_lon")
    bad_lat = ~(F.coalesce(plat.between(-90, 90), F.lit(False)) & F.coalesce(dlat.between(-90, 90), F.lit(False)))
    bad_lon = ~(F.coalesce(plon.between(-180, 180), F.lit(False)) & F.coalesce(dlon.between(-180, 180), F.lit(False)))
    geo = development.select(F.col("distance").cast("double").alias("distance"),
                             haversine(plat, plon, dlat, dlon).alias("hav"), bad_lat.alias("bl"), bad_lon.alias("bo"))
    ratio = geo.select((F.col("distance") / at_least(F.col("hav"), 1.0)).alias("r"))
    med_ratio = exact_quantiles(ratio, [], "r", [0.5], ["m"]).select("m").scalar()
    g = one_row(geo.agg(F.count_if("bl").alias("bl"), F.count_if("bo").alias("bo"), F.corr("distance", "hav").alias("c")))
    cities = one_row(development.agg(F.count_distinct("pickup").alias("p"), F.count_distinct("delivery").alias("q")))
    return development.sparkSession.range(1).select(
        d.getField("rows").alias("development_rows"),
        F.lit(len(development.columns)).alias("development_columns"),
        v.getField("rows").alias("validation_rows"),
        F.lit(len(validation.columns)).alias("validation_columns"),
        scenario.agg(F.count(F.lit(1))).scalar().alias("scenario_rows"),
        F.lit(len(scenario.columns)).alias("scenario_columns"),
        F.lit(target).alias("target"),
        d.getField("d0").alias("development_date_start"),
        d.getField("d1").alias("development_date_end"),
        v.getField("d0").alias("validation_date_start"),
        v.getField("d1").alias("validation_date_end"),
        (v.getField("d0") > d.getField("d1")).alias("validation_strictly_later"),
        cities.getField("p").alias("unique_pickup_cities"),
        cities.getField("q").alias("unique_delivery_cities"),
        dup_rows(development).alias("duplicate_rows_development"),
        dup_rows(validation).alias("duplicate_rows_validation"),
        d.getField("dup_ids").alias("duplicate_ids_development"),
        v.getField("dup_ids").alias("duplicate_ids_validation"),
        d.getField("bad_dates").alias("invalid_dates_development"),
        v.getField("bad_dates").alias("invalid_dates_validation"),
        d.getField("neg_w").alias("negative_weight_rows_development"),
        v.getField("neg_w").alias("negative_weight_rows_validation"),
        g.getField("bl").alias("invalid_latitude_rows"),
        g.getField("bo").alias("invalid_longitude_rows"),
        g.getField("c").alias("distance_haversine_correlation"),
        med_ratio.alias("median_distance_haversine_ratio"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value (NULL kept as its own group)."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit(column).alias("column"), "value", "rows")
