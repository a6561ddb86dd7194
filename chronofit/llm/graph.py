"""Connected components of a link table by union-find inside tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textarrays import releasing


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task; gives each node's smallest node as its root."""
    parent: dict = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x < y:
                parent[y] = x
            elif y < x:
                parent[x] = y
    if schema is not None:
        pairs = [(x, root(x)) for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], schema.field(i).type) for i in (0, 1)],
                                         schema=schema)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns a and b); root is the smallest node reachable.

    Links within a task are reduced to a forest first.  Then large-star and small-star
    steps alternate until the links no longer change; each step groups by node with
    map-side minima and writes its result to shared storage, so no group and no
    component ever has to fit in one task.
    """
    links = links.select("a", "b").filter(F.col("a") != F.col("b"))
    forest = links.mapInArrow(releasing(_forest), links.schema).distinct()
    current, seen = materialise(forest, name), None
    while True:
        state = current.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))).alias("h")).first()
        if state["n"] == 0 or state == seen:
            return _roots(current)
        seen = state
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b")
        current = materialise(small.filter(F.col("a") != F.col("b")).distinct(), name)


def _roots(stars: DataFrame) -> DataFrame:
    """Converged links are stars: every node but the root links to the root."""
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b"), F.col("b")).distinct())
