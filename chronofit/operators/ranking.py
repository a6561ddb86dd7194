"""Skew-aware ranking within groups.

A plain ``row_number() OVER (PARTITION BY g ORDER BY o)`` sorts every group inside one
task, so a single hot group (a third of all rows) would land on one executor.  So the
groups are counted first, by the hash of their key in ``BUCKETS`` buckets with map-side
combining.  Groups of buckets up to ``hot_rows`` rows are numbered by that window: one shuffle,
which a following join on the same key uses as well.

The rows of larger buckets are range-partitioned and sorted by (group, order, salt); the random salt
lets the range partitioner split even a group of identical copies.  The sorted rows are
written once to the shared checkpoint folder with ``monotonically_increasing_id``, which
follows that order.  A row's position is that number with the gaps between partitions
closed (one number per partition), and its rank is its position less its group's first.
All of it is JVM-side and counts in 64 bits.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import output_dir, write_table
from .lookup import counted_lookup

BUCKETS = 1 << 16
#: Rows of a bucket that one task may sort.
HOT_ROWS_KEY = "chronofit.hot_rows"
DEFAULT_HOT_ROWS = 500_000


def _positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], seed: int) -> DataFrame:
    """``df`` with ``__pos``: the 0-based place of each row in (group, order) order over the whole table."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c).asc_nulls_first() for c in [*group_cols, *order_cols]] + [F.col("__salt")]
    ordered = (df.withColumn("__salt", F.rand(seed))
               .repartitionByRange(parts, *sort_cols)
               .sortWithinPartitions(*sort_cols)
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__mono", F.monotonically_increasing_id())
               .drop("__salt"))
    stored = write_table(ordered, output_dir(spark, "ranked"))
    sizes = stored.groupBy("__pid").agg(F.count(F.lit(1)).alias("n"), F.min("__mono").alias("m"))
    shift, total = [], 0
    for r in sorted(sizes.collect(), key=lambda r: r["__pid"]):   # one row per partition
        shift.append((int(r["__pid"]), total - int(r["m"])))
        total += int(r["n"])
    offsets = spark.createDataFrame(shift, "__pid int, __shift long")
    return (stored.join(F.broadcast(offsets), "__pid")
            .withColumn("__pos", F.col("__mono") + F.col("__shift")).drop("__pid", "__mono", "__shift"))


def _with_groups(placed: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Join each row with its group's first position and size.

    Groups are aggregated with map-side combining and counted; a few are broadcast, and of many
    a hot one's rows are split by the skew handling of the join.
    """
    names = [f"__g_{i}" for i in range(len(group_cols))]
    groups = counted_lookup(placed.groupBy(*[F.col(c).alias(n) for c, n in zip(group_cols, names)]).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__size")), "ranked_groups")
    cond = F.lit(True)
    for c, n in zip(group_cols, names):
        cond = cond & F.col(c).eqNullSafe(F.col(n))
    return placed.join(groups, cond).drop(*names)


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                       rank_col: str = "rank", seed: int = 42, deal_by: Sequence[str] | None = None, size_col: str | None = None) -> DataFrame:
    """Add ``rank_col`` = row_number() within each group in ``order_cols`` order (1-based, long).

    Rows that tie on every order column get distinct, arbitrary numbers, exactly like
    ``row_number``; callers that need a unique answer order by all columns.  NULL keys
    form one group; NULLs sort first.  ``deal_by``: those of the group columns by which the rows are
    shuffled (all, if not given); ``size_col``: a column for the group's rows.
    """
    groups = list(group_cols)
    deal = list(deal_by or groups)
    bucket = F.pmod(F.xxhash64(*deal), F.lit(BUCKETS))
    limit = int(df.sparkSession.conf.get(HOT_ROWS_KEY, str(DEFAULT_HOT_ROWS)))
    hot = [r[0] for r in df.groupBy(bucket.alias("b")).count().where(F.col("count") > limit).select("b").collect()]  # BUCKETS at most

    def numbered(rows):
        within = Window.partitionBy(*groups)
        out = rows.repartition(*deal).withColumn(rank_col, F.row_number().over(
            within.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])).cast("long"))
        return out.withColumn(size_col, F.count(F.lit(1)).over(within)) if size_col else out

    def placed(rows):
        out = _with_groups(_positions(rows, groups, order_cols, seed), groups).withColumn(rank_col, F.col("__pos") - F.col("__first") + 1)
        return (out.withColumn(size_col, F.col("__size")) if size_col else out).drop("__pos", "__first", "__size")
    if not hot:
        return numbered(df)
    if len(hot) == BUCKETS:
        return placed(df)
    large = bucket.isin(hot)
    return numbered(df.where(~large)).unionByName(placed(df.where(large)))
