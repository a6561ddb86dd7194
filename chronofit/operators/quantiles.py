"""Exact group quantiles by radix selection: the rows are counted, never sorted, written or joined.

A double becomes a 64-bit number of the same order.  Rows are counted per (group, leading
bits) with map-side combining; the running counts tell in which bucket each wanted rank
falls, and only that bucket is counted again by its next bits.  A bucket whose smallest and
largest values are equal ends the search early, which on most tables is after two of the
four rounds.  So a round moves a few buckets per group and task, whatever the number of
rows, and a group holding a third of the table costs what any other does.

Windows that share rows (expanding folds, splits) share the counts as well: rows are counted
once per part of the time line, and a window's counts are the sums of its parts'.

All columns, groups and windows of a call share its passes.  What a round keeps (a row per group and
wanted rank) is written to the shared folder and counted before it is broadcast to the rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import broadcast_rows, stored_table

#: Bits of a round; four rounds tell all doubles apart.
ROUND_BITS = 16
_ROUNDS = 64 // ROUND_BITS
_SMALLEST_NORMAL = 2.0 ** -1022


def _key_pieces(value: Column) -> tuple[Column, Column]:
    """A guess at the exponent (off by one at most) and the value's size scaled by it, which is exact."""
    guess = F.least(F.floor(F.log2(F.abs(value))), F.lit(1023))   # the logarithm of the largest doubles is rounded up
    return guess, F.abs(value) / F.pow(F.lit(2.0), guess)


def _key_of(value: Column, guess: Column, scaled: Column) -> Column:
    a = F.abs(value)
    one = F.lit(1 << 52)
    fraction = (F.when(scaled < 1, (scaled - 1) * 2.0 ** 53).when(scaled >= 2, scaled * 2.0 ** 51)
                .otherwise((scaled - 1) * 2.0 ** 52)).cast("bigint")
    bits = (F.when(a == 0, F.lit(0).cast("bigint"))
            .when(a == float("inf"), F.lit(2047 << 52))
            .when(a < _SMALLEST_NORMAL, (a * 2.0 ** 537 * 2.0 ** 537).cast("bigint"))
            .otherwise((guess + 1023) * one + fraction))
    return F.when(value.isNotNull() & ~F.isnan(value), bits * F.when(value < 0, -1).otherwise(1))


def order_key(value: Column) -> Column:
    """The bits of a double as a BIGINT of the same order (NULL and NaN have none; -0.0 equals 0.0).

    The exponent comes from a logarithm, corrected by what scaling with it gives; scaling by powers
    of two is exact.
    """
    return _key_of(value, *_key_pieces(value))


def _with_key(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__key``, made in steps that are columns, so that none is computed twice."""
    guess, _ = _key_pieces(F.col("__v"))
    rows = rows.withColumn("__guess", guess)
    rows = rows.withColumn("__scaled", F.abs("__v") / F.pow(F.lit(2.0), F.col("__guess")))
    return rows.withColumn("__key", _key_of(F.col("__v"), F.col("__guess"), F.col("__scaled"))).drop("__guess", "__scaled")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _counted(rows: DataFrame, keys: Sequence[str], step: int, windows: DataFrame | None) -> DataFrame:
    """Rows and least and largest value per (keys, bucket of this round), and the rows before it; per window if given."""
    bucket = F.shiftright("__key", 64 - ROUND_BITS * (step + 1)).alias("__bucket")
    stats = [F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]
    if windows is None:
        cells = rows.groupBy(*keys, bucket).agg(*stats)
    else:
        parts = rows.groupBy(*keys, "__part", bucket).agg(*stats)
        keys = ["__window", *keys]
        cells = parts.join(F.broadcast(windows), "__part").groupBy(*keys, "__bucket").agg(
            F.sum("__c").alias("__c"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    order = Window.partitionBy(*keys).orderBy("__bucket")  # 2 ** ROUND_BITS buckets at most
    return cells.withColumn("__before", F.sum("__c").over(order) - F.col("__c"))


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str], windows: DataFrame | None = None, part_col: str = "part") -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value_col`` per group.

    ``windows``: a small table ``(window, part)`` of which parts (values of ``part_col``) make up
    each window; the result then has a column ``window`` in front.

    Same definition as pandas ``quantile`` / SQL ``percentile`` / ``quantile_cont``;
    NULL and NaN values are ignored.  Groups with no value are absent; NULL keys are a group.
    """
    groups = [f"__g{i}" for i in range(len(group_cols))]
    v = F.col(value_col).cast("double")
    extra, own = [], groups
    if windows is not None:
        windows = windows.select(F.col("window").alias("__window"), F.col("part").alias("__part"))
        extra, own = [F.col(part_col).alias("__part")], ["__window", *groups]
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], v.alias("__v"), *extra)
    rows = rows.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    rows = _with_key(rows)

    cells = _counted(rows, groups, 0, windows)
    whole = Window.partitionBy(*own)
    place = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), fn(h).cast("bigint").alias("rank"))
                                for i, h in enumerate(place) for side, fn in (("lo", F.floor), ("hi", F.ceil))]))
    state = [*own, "__n", "__i", "__side", "__rank", "__bucket", "__lo", "__hi"]
    inside = (F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__c"))
    wanted = (cells.withColumn("__n", F.sum("__c").over(whole)).select("*", ranks.alias("__w"))
              .select("*", F.col("__w.i").alias("__i"), F.col("__w.side").alias("__side"), F.col("__w.rank").alias("__rank")).where(inside)
              .withColumn("__rank", F.col("__rank") - F.col("__before")))
    wanted, _ = stored_table(wanted.select(*state), "quantile_ranks")
    found = [wanted.where(F.col("__lo") == F.col("__hi"))]
    for step in range(1, _ROUNDS):
        open_ = wanted.where(F.col("__lo") < F.col("__hi"))
        again = open_.select(*[F.col(g).alias(f"{g}_") for g in groups], F.col("__bucket").alias("__prefix")).distinct()
        n = again.count()
        if not n:
            break
        hint = F.broadcast(again) if n <= broadcast_rows(df) else again
        prefix = F.shiftright("__key", 64 - ROUND_BITS * step)
        # null-safe, so that no filter with the whole key in it is inferred from a join
        at = rows.withColumn("__prefix", prefix)
        near = at.join(hint.withColumnRenamed("__prefix", "__open"), _same([*groups, "__prefix"], [*[f"{g}_" for g in groups], "__open"]), "left_semi")
        cells = _counted(near, [*groups, "__prefix"], step, windows)
        cells = cells.select(*[F.col(g).alias(f"{g}_") for g in own], "__prefix", "__before", "__c", F.col("__bucket").alias("__next"),
                             F.col("__lo").alias("__low"), F.col("__hi").alias("__high"))
        deeper = open_.join(cells, _same([*own, "__bucket"], [*[f"{g}_" for g in own], "__prefix"])).where(inside)
        wanted, _ = stored_table(deeper.select(*own, "__n", "__i", "__side", (F.col("__rank") - F.col("__before")).alias("__rank"),
                                               F.col("__next").alias("__bucket"), F.col("__low").alias("__lo"), F.col("__high").alias("__hi")), "quantile_ranks")
        found.append(wanted.where(F.col("__lo") == F.col("__hi")))
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    aggs = []
    for i, (p, name) in enumerate(zip(probs, names)):
        lo, hi = (F.max(F.when((F.col("__i") == i) & (F.col("__side") == side), F.col("__lo"))) for side in ("lo", "hi"))
        h = (F.max("__n") - 1) * F.lit(float(p))
        part = h - F.floor(h)
        aggs.append(F.when(part == 0, lo).otherwise(lo * (1 - part) + hi * part).alias(name))
    keyed = values.groupBy(*own).agg(*aggs) if own else values.groupBy(F.lit(0).alias("__all")).agg(*aggs).drop("__all")
    lead = [F.col("__window").alias("window")] if windows is not None else []
    return keyed.select(*lead, *[F.col(g).alias(c) for g, c in zip(groups, group_cols)], *names)
