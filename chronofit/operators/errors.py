"""Holdout error analysis.

``holdout_errors`` tags each predicted holdout row with its residual and the six
segment keys; ``segment_errors`` computes the regression metrics of all six segment
dimensions in ONE grouping-sets aggregate (one shuffle) instead of six group-bys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.features import distance_band
from ..functions.metrics import error_terms, regression_aggs
from .lookup import counted_lookup
from .quantiles import exact_quantiles

SEGMENT_DIMENSIONS = ["month", "distance_band", "equipment", "target_band", "route_status", "city_status"]
ROUTE_UNSEEN, ROUTE_RARE, ROUTE_COMMON = "Unseen", "Rare (<10)", "Common (>=10)"
CITY_UNSEEN, CITY_SEEN = "Unseen city", "Seen cities"


def holdout_errors(predicted: DataFrame, training: DataFrame, actual: str = K.TARGET,
                   rare_threshold: int = K.RARE_THRESHOLD) -> DataFrame:
    """Rows of (load_id, date, actual, predicted, residual, absolute_error, segment keys).

    ``predicted`` holds holdout rows with a ``predicted`` column.  Route status compares
    raw ``pickup > delivery`` strings with training route counts; city status is
    role-specific (pickup vs training pickups, delivery vs training deliveries).
    Target-band edges are the exact 25th/75th percentiles of the holdout actuals.
    """
    route = F.concat(F.col("pickup").cast("string"), F.lit(K.ROUTE_SEPARATOR), F.col("delivery").cast("string"))
    rows = predicted.select("load_id", F.col("date").cast("date").alias("date"),
                            F.col(actual).cast("double").alias("actual"), F.col("predicted").cast("double"),
                            F.col("distance").cast("double").alias("distance"),
                            F.col("equipment").cast("string").alias("equipment"),
                            route.alias("__route"), F.col("pickup").cast("string").alias("__p"),
                            F.col("delivery").cast("string").alias("__d"))
    train_routes = training.select(route.alias("__route")).groupBy("__route").agg(
        F.count(F.lit(1)).alias("__rc"))
    pickups = training.select(F.col("pickup").cast("string").alias("__p")).distinct().withColumn("__sp", F.lit(1))
    deliveries = training.select(F.col("delivery").cast("string").alias("__d")).distinct() \
        .withColumn("__sd", F.lit(1))
    edges = exact_quantiles(rows, [], "actual", K.TARGET_BAND_QUANTILES, ["__q1", "__q3"])
    q1, q3 = edges.select("__q1").scalar(), edges.select("__q3").scalar()
    tagged = (rows.join(counted_lookup(train_routes, "route_counts"), "__route", "left")
              .join(counted_lookup(pickups, "pickup_cities"), "__p", "left")
              .join(counted_lookup(deliveries, "delivery_cities"), "__d", "left"))
    rc = F.coalesce(F.col("__rc"), F.lit(0))
    t = error_terms("actual", "predicted")
    return tagged.select(
        "load_id", "date", "actual", "predicted",
        t["residual"].alias("residual"), t["absolute_error"].alias("absolute_error"),
        F.date_format("date", "yyyy-MM").alias("month"),
        distance_band(F.col("distance")).alias("distance_band"),
        F.col("equipment"),
        F.when(F.col("actual") <= q1, F.lit(K.TARGET_BAND_LABELS[0]))
        .when(F.col("actual") <= q3, F.lit(K.TARGET_BAND_LABELS[1]))
        .otherwise(F.lit(K.TARGET_BAND_LABELS[2])).alias("target_band"),
        F.when(rc == 0, F.lit(ROUTE_UNSEEN)).when(rc < rare_threshold, F.lit(ROUTE_RARE))
        .otherwise(F.lit(ROUTE_COMMON)).alias("route_status"),
        F.when(F.col("__sp").isNull() | F.col("__sd").isNull(), F.lit(CITY_UNSEEN))
        .otherwise(F.lit(CITY_SEEN)).alias("city_status"),
    )


def segment_errors(errors: DataFrame, dimensions=tuple(SEGMENT_DIMENSIONS), with_total: bool = False) -> DataFrame:
    """(dimension, segment, rows, mae, rmse, r2, smape, mean_error) by GROUPING SETS."""
    dims = list(dimensions)
    sets = [[d] for d in dims] + ([[]] if with_total else [])
    agg = errors.groupingSets(sets, *dims).agg(*regression_aggs("actual", "predicted"),
                                              F.grouping_id(*dims).alias("__gid"))
    n = len(dims)
    dim_name = F.lit("all")
    segment = F.lit("all")
    for i, d in enumerate(dims):
        gid = ((1 << n) - 1) ^ (1 << (n - 1 - i))      # only dimension i is grouped
        dim_name = F.when(F.col("__gid") == gid, F.lit(d)).otherwise(dim_name)
        segment = F.when(F.col("__gid") == gid, F.coalesce(F.col(d).cast("string"), F.lit("nan"))) \
            .otherwise(segment)
    return agg.select(dim_name.alias("dimension"), segment.alias("segment"),
                      "rows", "mae", "rmse", "r2", "smape", "mean_error")


def daily_errors(errors: DataFrame) -> DataFrame:
    """Holdout MAE and bias by date."""
    return errors.groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.avg("absolute_error").alias("mae"),
                                      F.avg("residual").alias("bias"))
