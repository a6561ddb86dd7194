"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key scaled by its quality weight
(``-ln(u) / weight``); the documents of a source in key order are a weighted random
order without replacement.  A source takes complete epochs first and then the prefix
of that order that fits the rest of its word target.  What the prefix leaves is filled
in the same order: each later document is taken if it fits what is then left, until no
document of the source fits.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, ...; they share the
budget (all words) by weight, and no source gets more than ``max_epochs`` times its
words; the excess goes to the others by weight (water filling on the per-source table).

Scale: the prefix cut needs no sort of a source.  Keys map to 1,024 coarse and 1,024
fine buckets per source; bucket sums (map-side combined) give the bucket that holds
the cut, and only the rows of that fine bucket, a millionth of a source, are ordered.
Filling is the same cut again over the rows behind the last one that fit the gap; each
round's gap is below the size of the row that crossed, so it shrinks fast, and the rounds
end when no row is left that could cross.  The per-document table holds keys and sizes;
it is written once and read three times in each round.

Defined cases: null or empty text has size 0 and takes 0; an empty table gives an empty
result; null sources form one source; null ids are kept; of repeated rows each counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, n_words, uniform

MAX_EPOCHS = 3
BUCKETS = 1024
SEED = 20240607


def quality_weight(text: Column) -> Column:
    """Share of letters and spaces in a text, between 0.1 and 1 (1 for an empty text)."""
    t = F.coalesce(text, F.lit(""))
    odd = F.length(F.regexp_replace(t, "[\\p{L}\\x20\\x09-\\x0D]+", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - odd / F.greatest(F.length(t), F.lit(1)))


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size)`` rows with a ``target`` each (one small row per source)."""
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("w", ((F.row_number().over(
        everything.orderBy(F.col("source").isNull(), F.col("source"))) - 1) % 3 + 1).cast("double"))
    cap = F.lit(max_epochs) * F.col("source_size")
    by_ratio = everything.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (ranked.withColumn("ratio", cap / F.col("w"))
              .withColumn("level", (F.sum("source_size").over(everything)
                                    - F.coalesce(F.sum(cap).over(before), F.lit(0)))
                          / F.sum("w").over(after))
              .withColumn("water", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("ratio")))
                          .over(everything)))
    # the level of the first source, in ratio order, that the level does not overfill
    levels = levels.withColumn("water", F.max(F.when(F.col("ratio") == F.col("water"), F.col("level"))
                                              ).over(everything))
    return levels.select("source", "source_size",
                         F.least(cap.cast("double"), F.col("water") * F.col("w")).alias("target"))


def _bucket(level: int) -> Column:
    """Bucket of a key at level 1 (coarse) or 2 (fine, inside the coarse one); monotone in the key."""
    v = (F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS
    coarse = F.least(F.floor(v), F.lit(BUCKETS - 1))
    if level == 1:
        return coarse
    return F.least(F.floor((v - coarse) * BUCKETS), F.lit(BUCKETS - 1))


def _cut_bucket(rows: DataFrame, need: DataFrame, bucket: str) -> DataFrame:
    """Per source: the bucket where the running size passes ``need``, and ``need`` less what lies before."""
    sums = rows.groupBy("source", bucket).agg(F.sum("size").alias("s"))
    running = Window.partitionBy("source").orderBy(bucket)
    return (sums.withColumn("upto", F.sum("s").over(running)).alias("a")
            .join(need.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
            .filter(F.col("upto") > F.col("need"))
            .groupBy("b.source").agg(
                F.min(F.struct(F.col(bucket), (F.col("need") - F.col("upto") + F.col("s")).alias("rest"))).alias("m"))
            .select("source", F.col(f"m.{bucket}").alias(f"at_{bucket}"), F.col("m.rest").alias("need")))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_epochs: int = MAX_EPOCHS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, size, source_size, target, epochs, copies, taken, and ``carry``.

    ``copies`` is how often the mix takes the document; ``taken`` is copies times size.
    The cut keeps identical rows apart by a row number that is stored with them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text).alias("size"),
        (-F.log(uniform(F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text)))) / quality_weight(text)).alias("key"),
        *[F.col(c).alias(f"carry_{c}") for c in carry],
    ).withColumn("rid", F.monotonically_increasing_id())
    rows = materialise(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = (source_targets(sizes, max_epochs)
               .withColumn("epochs", F.when(F.col("source_size") > 0, F.least(
                   F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long"))
               .withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size")))
    targets = materialise(targets.coalesce(1), "mix-targets")
    n_sources = targets.count()
    draw = rows.select("source", "size", "key", "rid", _bucket(1).alias("b1"), _bucket(2).alias("b2"))

    def at(frame: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
        side = broadcast_if_small(per_source.withColumnRenamed("source", "s_source"), n_sources)
        return frame.join(side, F.col("source").eqNullSafe(F.col("s_source")), how).drop("s_source")

    place = F.struct("b1", "b2", "key", "rid")

    def next_cut(left: DataFrame, need: DataFrame) -> DataFrame:
        """Per source whose ``left`` rows exceed ``need``: the last place that fits, and the gap behind it."""
        coarse = materialise(_cut_bucket(left, need, "b1").coalesce(1), "mix-coarse")
        in_coarse = at(left, coarse.select("source", "at_b1")).filter(F.col("b1") == F.col("at_b1"))
        fine = _cut_bucket(in_coarse, coarse.select("source", "need"), "b2")
        fine = materialise(at(fine, coarse.select("source", "at_b1")).coalesce(1), "mix-fine")
        edge = at(left, fine).filter((F.col("b1") == F.col("at_b1")) & (F.col("b2") == F.col("at_b2")))
        order = Window.partitionBy("source").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, 0)
        edge = edge.withColumn("upto", F.sum("size").over(order))
        cut = edge.groupBy("source").agg(
            F.max(F.when(F.col("upto") <= F.col("need"), F.struct("key", "rid", "upto"))).alias("m"),
            F.first("need").alias("need"), F.first("at_b1").alias("at_b1"), F.first("at_b2").alias("at_b2"))
        # without a row of the fine bucket that fits, key and rid are null, which sorts before its rows
        return materialise(cut.select(
            "source", F.struct(F.col("at_b1").alias("b1"), F.col("at_b2").alias("b2"), F.col("m.key").alias("key"),
                               F.col("m.rid").alias("rid")).alias("place"),
            F.floor(F.col("need") - F.coalesce(F.col("m.upto"), F.lit(0))).alias("gap")).coalesce(1), "mix-cut")

    cuts = [next_cut(draw, targets.select("source", "need"))]
    while not cuts[-1].isEmpty():
        left = at(draw, cuts[-1].withColumnRenamed("gap", "room")).filter(
            (place > F.col("place")) & (F.col("size") > 0) & (F.col("size") <= F.col("room"))).drop("place", "room")
        cuts.append(next_cut(left, cuts[-1].select("source", F.col("gap").alias("need"))))
    per_source = reduce(DataFrame.unionByName, cuts).groupBy("source").agg(
        F.collect_list(F.struct("place", "gap")).alias("cuts")).withColumnRenamed("source", "c_source")
    plan = targets.alias("t").join(per_source, F.col("t.source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    plan = materialise(plan.coalesce(1), "mix-plan")
    out = at(rows.withColumn("b1", _bucket(1)).withColumn("b2", _bucket(2)), plan.drop("need"))
    # a row is in the part of an epoch if it fits the gap of every cut it lies behind; sources without a cut take no part
    part = F.forall("cuts", lambda c: (place <= c["place"]) | ((F.col("size") > 0) & (F.col("size") <= c["gap"])))
    copies = F.col("epochs") + F.coalesce(part, F.lit(False)).cast("long")
    return out.withColumn("copies", copies).select(
        "id", "size", "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"carry_{c}") for c in carry])


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix as rows of ``df``: each document as often as the mix takes it (empty texts once per epoch)."""
    columns = df.columns
    out = mix(df, id_col, text_col, source_col, carry=tuple(columns)).filter(F.col("copies") > 0)
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"carry_{c}").alias(c) for c in columns]))
