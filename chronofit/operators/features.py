"""Leakage-safe feature engine: fit state on training rows, transform any rows.

Fitted state (E1, E2, E6-E8):
  * scalars - reference date (min training date), training row count, medians of the
    raw numerics (exact).  One-row aggregates, held on the driver like any MLlib model.
  * ``counts``      - long table (key_column, key, count, frequency) for the seven
    frequency keys, computed in ONE unpivot + group-by pass.
  * ``coordinates`` - (city, lat, lon) exact medians over stacked pickup/delivery rows.
  Key tables are written to the shared checkpoint folder and their row counts kept,
  so each lookup join is a broadcast only when the table is proven small, otherwise a
  shuffle join (AQE handles skewed keys).

Transform (E3-E5, J1, J2, P2-P13, §2.4-2.6) is one lazy plan of Column expressions
plus those lookups; only the requested features are projected and Catalyst prunes the rest.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import base_clean, normalise_category
from ..functions.features import (composite_keys, date_features, geographic_features,
                                  interaction_features)
from .lookup import broadcast_rows, counted_lookup, stored_table
from .quantiles import exact_quantiles
from .split import Scope, time_part, training_windows


@dataclass
class FeatureState:
    reference_date: _dt.date
    rows: int
    medians: dict[str, float]
    counts: DataFrame
    coordinates: DataFrame
    counts_rows: int
    coordinates_rows: int
    rare_threshold: int = K.RARE_THRESHOLD
    impute_numeric: bool = False
    holidays: Sequence[str] = field(default_factory=lambda: list(K.FEDERAL_HOLIDAYS))

    def save(self, path: str) -> None:
        """Persist the state as parquet tables."""
        spark = self.counts.sparkSession
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.coordinates.write.mode("overwrite").parquet(f"{path}/coordinates")
        scalars = [("reference_date", str(self.reference_date)), ("rows", str(self.rows)),
                   ("rare_threshold", str(self.rare_threshold)),
                   ("impute_numeric", str(self.impute_numeric))]
        scalars += [(f"median:{k}", repr(v)) for k, v in self.medians.items()]
        scalars += [(f"holiday:{i}", str(h)) for i, h in enumerate(self.holidays)]
        spark.createDataFrame(scalars, "name string, value string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/scalars")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureState":
        scal = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/scalars").collect()}
        counts = spark.read.parquet(f"{path}/counts")
        coords = spark.read.parquet(f"{path}/coordinates")
        return cls(reference_date=_dt.date.fromisoformat(scal["reference_date"]), rows=int(scal["rows"]),
                   medians={k.split(":", 1)[1]: float(v) for k, v in scal.items() if k.startswith("median:")},
                   counts=counts, coordinates=coords, counts_rows=counts.count(),
                   coordinates_rows=coords.count(), rare_threshold=int(scal["rare_threshold"]),
                   impute_numeric=scal["impute_numeric"] == "True",
                   holidays=[v for _, v in sorted((int(k.split(":", 1)[1]), v) for k, v in scal.items()
                                                  if k.startswith("holiday:"))])


def _clean(df: DataFrame) -> DataFrame:
    """``base_clean`` whose names are normalised once per distinct text, not per row."""
    named = [c for c in K.RAW_CATEGORICAL if c in df.columns]
    if not named:
        return base_clean(df)
    raw = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in named])).alias("__raw")).distinct()
    names = counted_lookup(raw.select("__raw", normalise_category("__raw").alias("__name")), "names")
    for c in named:
        df = df.join(names, F.col(c).cast("string").eqNullSafe(F.col("__raw")), "left").withColumn(c, F.col("__name")).drop("__raw", "__name")
    return base_clean(df, named)


def _state_rows(df: DataFrame) -> DataFrame:
    """``df`` with the columns only that a state is fitted on: its cleaned rows are written."""
    return df.select(*[c for c in df.columns if c == "date" or c in K.RAW_NUMERIC or c in K.RAW_CATEGORICAL])


def _lookup(df: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """Broadcast a state table only below the checked row bound."""
    return F.broadcast(table) if size <= broadcast_rows(df) else table


def fit(df: DataFrame, rare_threshold: int = K.RARE_THRESHOLD, impute_numeric: bool = False,
        checkpoint: bool = True) -> FeatureState:
    """Fit the feature state on training rows only (E9: ``transform(fit(train), rows)``)."""
    base = _clean(_state_rows(df))
    if checkpoint:
        # Every statistic below reads the cleaned rows: clean (regex title case) once.
        base, _ = stored_table(base, "clean_rows")
    head = base.agg(F.min("date").alias("d"), F.count(F.lit(1)).alias("n"),
                    F.count_if(F.col("date").isNull()).alias("bad")).first()
    if head["bad"]:
        raise ValueError("Invalid dates found in training data")
    rows = int(head["n"])
    # Exact medians of every raw numeric, one unpivot + one quantile pass.
    long = base.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in K.RAW_NUMERIC])).alias("kv")
    ).select("kv.*")
    med_rows = exact_quantiles(long, ["column"], "value", [0.5], ["median"]).collect()  # <= 8 rows
    medians = {r["column"]: float(r["median"]) for r in med_rows}
    # City coordinates = median lat/lon over stacked pickup and delivery rows with no NULL.
    coordinates = _wide_coordinates(exact_quantiles(_stacked_coordinates(base), ["city", "axis"], "v", [0.5], ["m"]))
    if impute_numeric:
        base = _impute(base, medians)
    counts = _key_counts(base).withColumn("frequency", F.col("count") / F.lit(float(max(rows, 1))))   # E2
    counts, n_counts = stored_table(counts, "key_counts")
    coordinates, n_coordinates = stored_table(coordinates, "coordinates")
    return FeatureState(reference_date=head["d"], rows=rows, medians=medians, counts=counts, coordinates=coordinates,
                        counts_rows=n_counts, coordinates_rows=n_coordinates, rare_threshold=rare_threshold,
                        impute_numeric=impute_numeric)


def fit_transform(df: DataFrame, features: Sequence[str] | None = None, **options) -> tuple[FeatureState, DataFrame]:
    """E9 as one call: the state fitted on ``df`` and its own features."""
    state = fit(df, **options)
    return state, transform(state, df, features)


def fit_scopes(df: DataFrame, scopes: Sequence[Scope], rare_threshold: int = K.RARE_THRESHOLD) -> dict[str, FeatureState]:
    """The states of many training windows from one pass over the rows: partial counts, dates and
    radix histograms are kept per part of the time line and added up per window.

    Equal to :func:`fit` on each window's rows; no row is copied per window.
    """
    spark = df.sparkSession
    windows = training_windows(spark, scopes)
    base = _clean(_state_rows(df))
    base, _ = stored_table(base.withColumn("__part", time_part(scopes).cast("int")), "clean_rows")
    inside = base.where(F.col("__part") < len({s.before for s in scopes}))
    heads = inside.groupBy("__part").agg(F.min("date").alias("d"), F.count(F.lit(1)).alias("n")).collect()   # a row a part
    if base.where(F.col("date").isNull()).limit(1).count():
        raise ValueError("Invalid dates found in training data")
    member = {}
    for r in windows.collect():
        member.setdefault(r["window"], set()).add(r["part"])
    long = inside.select("__part", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in K.RAW_NUMERIC])).alias("kv")).select("__part", "kv.*")
    medians: dict[str, dict[str, float]] = {s.name: {} for s in scopes}
    for r in exact_quantiles(long, ["column"], "value", [0.5], ["median"], windows, "__part").collect():   # scopes x columns
        medians[r["window"]][r["column"]] = float(r["median"])
    coord_q = exact_quantiles(_stacked_coordinates(inside, "__part"), ["city", "axis"], "v", [0.5], ["m"], windows, "__part")
    coordinates, _ = stored_table(_wide_coordinates(coord_q, "window"), "scope_coordinates")
    partial = _key_counts(inside, "__part")
    rows = {name: sum(r["n"] for r in heads if r["__part"] in parts) for name, parts in member.items()}
    sizes = spark.createDataFrame([(k, float(max(n, 1))) for k, n in rows.items()], "window string, n double")
    counts = partial.join(F.broadcast(windows.withColumnRenamed("part", "__part")), "__part").groupBy("window", "key_column", "key").agg(
        F.sum("count").alias("count")).join(F.broadcast(sizes), "window").withColumn("frequency", F.col("count") / F.col("n")).drop("n")
    counts, _ = stored_table(counts, "scope_counts")
    n_counts = {r["window"]: r["count"] for r in counts.groupBy("window").count().collect()}
    n_coords = {r["window"]: r["count"] for r in coordinates.groupBy("window").count().collect()}
    return {name: FeatureState(
        reference_date=min((r["d"] for r in heads if r["__part"] in parts), default=None), rows=rows[name], medians=medians[name],
        counts=counts.where(F.col("window") == name).drop("window"), coordinates=coordinates.where(F.col("window") == name).drop("window"),
        counts_rows=n_counts.get(name, 0), coordinates_rows=n_coords.get(name, 0), rare_threshold=rare_threshold)
        for name, parts in member.items()}


def _stacked_coordinates(base: DataFrame, *keep: str) -> DataFrame:
    """``(keep..., city, axis, v)`` of pickup and delivery rows with no NULL."""
    stacked = (base.select(*keep, F.col("pickup").alias("city"), F.col("pickup_lat").alias("lat"), F.col("pickup_lon").alias("lon"))
               .unionByName(base.select(*keep, F.col("delivery").alias("city"), F.col("delivery_lat").alias("lat"), F.col("delivery_lon").alias("lon")))
               .dropna())
    return stacked.select(*keep, "city", F.explode(F.array(
        F.struct(F.lit("lat").alias("axis"), F.col("lat").alias("v")),
        F.struct(F.lit("lon").alias("axis"), F.col("lon").alias("v")))).alias("kv")).select(*keep, "city", "kv.*")


def _wide_coordinates(medians: DataFrame, *keep: str) -> DataFrame:
    return medians.groupBy(*keep, "city").agg(F.max(F.when(F.col("axis") == "lat", F.col("m"))).alias("lat"),
                                              F.max(F.when(F.col("axis") == "lon", F.col("m"))).alias("lon"))


def _key_counts(base: DataFrame, *keep: str) -> DataFrame:
    """Counts of all seven keys (NULL-free after normalisation) in one pass."""
    keyed = base.select(*keep, *[v.alias(k) for k, v in composite_keys().items()], "pickup", "delivery", "equipment")
    return (keyed.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(k).alias("key_column"), F.col(k).alias("key")) for k in K.FREQUENCY_KEYS])).alias("kv"))
        .select(*keep, "kv.*").groupBy(*keep, "key_column", "key").agg(F.count(F.lit(1)).alias("count")))


def _impute(base: DataFrame, medians: dict[str, float]) -> DataFrame:
    return base.select(*[
        F.coalesce(F.col(c), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in base.columns])


def transform(state: FeatureState, df: DataFrame, features: Sequence[str] | None = None,
              keep: Sequence[str] = ("load_id", "date", K.TARGET)) -> DataFrame:
    """All features for ``df`` with the fitted state; project ``features`` (+ ``keep``)."""
    base = base_clean(df) if df.isStreaming else _clean(df)  # a stream's texts can't be listed beforehand
    coords = state.coordinates
    for role in ["pickup", "delivery"]:
        lookup = coords.select(F.col("city").alias(role), F.col("lat").alias(f"__{role}_lat"),
                               F.col("lon").alias(f"__{role}_lon"))
        base = (base.join(_lookup(base, lookup, state.coordinates_rows), on=role, how="left")
                .withColumn(f"{role}_lat", F.coalesce(F.col(f"{role}_lat"), F.col(f"__{role}_lat")))
                .withColumn(f"{role}_lon", F.coalesce(F.col(f"{role}_lon"), F.col(f"__{role}_lon")))
                .drop(f"__{role}_lat", f"__{role}_lon"))
    if state.impute_numeric:
        base = _impute(base, state.medians)
    base = base.select("*", *[v.alias(k) for k, v in composite_keys().items()])
    derived = {}
    derived.update(date_features(F.col("date"), state.reference_date, holidays=state.holidays))
    derived.update(geographic_features(F.col("distance")))
    derived.update(interaction_features())
    base = base.select("*", *[v.alias(k) for k, v in derived.items()])
    for k in K.FREQUENCY_KEYS:
        lookup = state.counts.where(F.col("key_column") == k).select(
            F.col("key").alias(k), F.col("count").alias(f"__{k}_count"), F.col("frequency").alias(f"__{k}_freq"))
        base = base.join(_lookup(base, lookup, state.counts_rows), on=k, how="left")
        cnt = F.coalesce(F.col(f"__{k}_count"), F.lit(0))
        extra = [F.coalesce(F.col(f"__{k}_freq"), F.lit(0.0)).alias(f"{k}_frequency")]
        if k in K.RARE_KEYS:
            extra += [cnt.between(1, state.rare_threshold - 1).cast("int").alias(f"rare_{k}"),
                      (cnt == 0).cast("int").alias(f"unseen_{k}")]
        base = base.select("*", *extra).drop(f"__{k}_count", f"__{k}_freq")
    if features is None:
        return base
    missing = [c for c in features if c not in base.columns]
    if missing:
        raise ValueError(f"Could not create required features: {missing}")
    kept = [c for c in keep if c in base.columns and c not in features]
    out = [F.coalesce(F.col(c), F.lit(K.UNKNOWN)).alias(c) if c in K.CATEGORICAL_FEATURES else F.col(c)
           for c in features]
    return base.select(*kept, *out)


def categorical_columns(features: Sequence[str]) -> list[str]:
    """Categorical features in feature order."""
    return [c for c in features if c in K.CATEGORICAL_FEATURES]
