"""Median baselines (A21, A22) as DataFrame predictions.

Both fit exact medians on training rows (skew-aware ``exact_quantiles``: a group such
as one equipment type holding a third of all rows never lands in one task) and attach
them to holdout rows through a lookup whose size is checked before it is broadcast.
``scoped_baselines`` fits both for many training windows at once: the rows are counted
once per part of the time line, whatever the number of windows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import normalise_category, to_double
from .lookup import counted_lookup
from .quantiles import exact_quantiles
from .split import Scope, holdout_rows, time_part, training_windows


def global_median(training: DataFrame, holdout: DataFrame, target: str = K.TARGET) -> DataFrame:
    """Predict the training target median for every holdout row."""
    med = exact_quantiles(training, [], target, [0.5], ["predicted"])
    return holdout.select("*", med.select("predicted").scalar().alias("predicted"))


def _with_group(df: DataFrame, group: str) -> DataFrame:
    """``df`` with ``__g``, its normalised group; the patterns run once per distinct value, not per row and pass."""
    raw = df.select(F.col(group).alias("__raw")).distinct()
    names = counted_lookup(raw.select("__raw", normalise_category("__raw").alias("__g")), "group_names")
    return df.join(names, F.col(group).eqNullSafe(F.col("__raw")), "left").drop("__raw")


def _rates(df: DataFrame, target: str, distance: str, *keep: str) -> DataFrame:
    rpm = F.try_divide(to_double(target), to_double(distance))
    return df.select(*keep, rpm.alias("__rpm"))


def group_median_rpm(training: DataFrame, holdout: DataFrame, group: str = "equipment",
                     target: str = K.TARGET, distance: str = "distance") -> DataFrame:
    """Rate-per-mile median of the holdout row's group x distance; global rpm median fallback.

    Group keys use the one category normaliser (documented deviation: the original only
    stripped and title-cased here).  Not floored at 1.0.
    """
    per_group = exact_quantiles(_rates(_with_group(training, group), target, distance, "__g"), ["__g"], "__rpm", [0.5], ["__m"])
    fallback = exact_quantiles(_rates(training, target, distance), [], "__rpm", [0.5], ["__f"])
    hold = _with_group(holdout, group)
    hold = hold.join(counted_lookup(per_group, "group_medians"), ["__g"], "left")
    hold = hold.select("*", fallback.select("__f").scalar().alias("__f"))
    return (hold.withColumn("predicted", F.coalesce(F.col("__m"), F.col("__f")) * to_double(distance))
            .drop("__g", "__m", "__f"))


def scoped_baselines(df: DataFrame, scopes: Sequence[Scope], group: str = "equipment", target: str = K.TARGET,
                     distance: str = "distance", date_col: str = "date") -> DataFrame:
    """Both baselines on the holdout of every scope: ``scope``, ``df``'s columns, ``global_median``, ``group_median``.

    One quantile call serves the medians of all groups and windows, a second the global ones.
    """
    windows = training_windows(df.sparkSession, scopes)
    named = _with_group(df, group)
    parted = named.withColumn("part", time_part(scopes, date_col)).where(F.col("part") < len({s.before for s in scopes}))
    per_group = exact_quantiles(_rates(parted, target, distance, "part", "__g"), ["__g"], "__rpm", [0.5], ["__m"], windows)
    overall = parted.select("part", F.explode(F.array(
        F.struct(F.lit("target").alias("kind"), to_double(target).alias("v")),
        F.struct(F.lit("rpm").alias("kind"), F.try_divide(to_double(target), to_double(distance)).alias("v")))).alias("kv")).select("part", "kv.*")
    overall = exact_quantiles(overall, ["kind"], "v", [0.5], ["m"], windows).groupBy(F.col("window").alias("scope")).agg(
        F.max(F.when(F.col("kind") == "target", F.col("m"))).alias("global_median"), F.max(F.when(F.col("kind") == "rpm", F.col("m"))).alias("__f"))
    hold = holdout_rows(named, scopes, date_col)
    hold = (hold.join(counted_lookup(per_group.withColumnRenamed("window", "scope"), "group_medians"), ["scope", "__g"], "left")
            .join(counted_lookup(overall, "overall_medians"), "scope", "left"))
    return hold.withColumn("group_median", F.coalesce("__m", "__f") * to_double(distance)).drop("__g", "__m", "__f")
