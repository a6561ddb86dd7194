"""Ordinal codes as a distributed dictionary, and exact median fills.

The codes of a column are the ranks of its distinct training values, from 0 in value order.
Distinct values are counted with map-side combining, numbered by range partitions and
per-partition offsets, and kept as a state table ``(column, value, code)`` that rows look
up; values without a code get -1.  No label list passes through the driver, and a tree's
``maxBins`` does not grow with the number of values, as codes are ordinals.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import broadcast_rows, stored_table
from .quantiles import exact_quantiles
from .ranking import rank_within_groups

UNKNOWN_CODE = -1


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, code)`` of the non-null values of ``columns``."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("kv"))
    values = long.select("kv.*").where(F.col("value").isNotNull()).distinct()
    ranked = rank_within_groups(values, ["column"], ["value"], "__rank")
    return ranked.select("column", "value", (F.col("__rank") - 1).alias("code"))


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str], rows: int, prefix: str = "__ix_") -> DataFrame:
    """``df`` with ``<prefix><column>``: the code of each value, -1 for values (and NULL) without one."""
    for c in columns:
        table = codes.where(F.col("column") == c).select(F.col("value").alias(f"__value_{c}"), F.col("code").cast("double").alias(f"__code_{c}"))
        table = F.broadcast(table) if rows <= broadcast_rows(df) else table
        df = (df.join(table, F.col(c).cast("string") == F.col(f"__value_{c}"), "left")
              .withColumn(f"{prefix}{c}", F.coalesce(F.col(f"__code_{c}"), F.lit(float(UNKNOWN_CODE)))).drop(f"__value_{c}", f"__code_{c}"))
    return df


@dataclass
class Encoder:
    """Codes of categorical features and fills of numeric ones, fitted on training rows."""

    codes: DataFrame | None
    rows: int
    fills: dict[str, float]

    @classmethod
    def fit(cls, feats: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> "Encoder":
        """``numeric``: the numeric features that rows may lack; the others are taken as they are (0 if missing)."""
        codes, rows = stored_table(fit_codes(feats, categorical), "ordinal_codes") if categorical else (None, 0)
        fills = dict.fromkeys(numeric, 0.0)  # a column without any value is constant
        if numeric:
            long = feats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in numeric])).alias("kv"))
            found = exact_quantiles(long.select("kv.*"), ["column"], "value", [0.5], ["median"]).collect()  # a row a column
            fills |= {r["column"]: float(r["median"]) for r in found}
        return cls(codes, rows, fills)

    def vectors(self, df: DataFrame, features: Sequence[str], categorical: Sequence[str]) -> DataFrame:
        """``df`` with the feature vector ``__x``; code columns that are there already are used."""
        todo = [c for c in categorical if f"__ix_{c}" not in df.columns]
        if todo:
            df = encode(df, self.codes, todo, self.rows)
        inputs = {}
        for c in features:
            v = F.col(f"__ix_{c}") if c in categorical else F.col(c).cast("double")
            inputs[f"__in_{c}"] = v if c in categorical else F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(self.fills.get(c, 0.0)))
        out = VectorAssembler(inputCols=list(inputs), outputCol="__x", handleInvalid="keep").transform(df.withColumns(inputs))
        return out.drop(*inputs, *[f"__ix_{c}" for c in todo])
