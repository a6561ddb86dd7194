"""Expected-id grids (C13): what a table of numbers lacks of a range, as islands.

The numbers found are made distinct and ranked by range partitions; number less rank is one
value per run of neighbours, so runs are one group-by.  A gap starts behind one run and ends
before the next: starts and ends are ranked each and paired by rank.  A missing million is
one row, and nothing passes through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import rank_within_groups


def _ranked(df: DataFrame, column: str, rank: str) -> DataFrame:
    return rank_within_groups(df.select(F.lit(0).alias("__all"), column), ["__all"], [column], rank).drop("__all")


def runs(df: DataFrame, column: str) -> DataFrame:
    """``(first, last)`` of each run of neighbouring whole numbers in ``column``; NULLs are left out."""
    found = df.select(F.col(column).cast("bigint").alias("n")).where(F.col("n").isNotNull()).distinct()
    placed = _ranked(found, "n", "__place")
    return placed.groupBy((F.col("n") - F.col("__place")).alias("run")).agg(F.min("n").alias("first"), F.max("n").alias("last")).drop("run")


def missing_ranges(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """``(first_missing, last_missing, missing)``: the gaps of ``column`` within ``first`` to ``last``."""
    spark = df.sparkSession
    inside = df.select(F.col(column).cast("bigint").alias("n")).where(F.col("n").between(first, last))
    # a number on either side closes the range, so gaps have as many starts as ends
    own = runs(inside.unionByName(spark.createDataFrame([(first - 1,), (last + 1,)], "n bigint")), "n")
    starts = _ranked(own.select((F.col("last") + 1).alias("first_missing")).where(F.col("first_missing") <= last), "first_missing", "__i")
    ends = _ranked(own.select((F.col("first") - 1).alias("last_missing")).where(F.col("last_missing") >= first), "last_missing", "__i")
    pairs = starts.join(ends, "__i").drop("__i")
    return pairs.withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)
