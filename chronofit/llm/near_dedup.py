"""Near-duplicate groups by SuperMinHash, banding, exact verification and union-find.

1. Each text becomes its set of word shingles (64-bit hashes) in one Arrow pass; the set
   gives a SuperMinHash signature, band keys and an identity.  Texts with equal sets form
   one class at once, so exact copies never meet in a group.
2. Classes that share a band key are candidates.  Every class is compared with its
   bucket's hub, the class whose buckets are largest (a star: no pairs within a group).
3. Similarity is verified on the full sets; links give components.
4. A bucket whose classes are still in several components holds unverified pairs.  A
   class that cannot reach the threshold there is proved so by its own shingles: those
   no other open class has cannot be shared.  The rest outside a cluster's largest
   component is compared with the whole cluster in blocks, which return links only.  So
   every candidate pair is verified, implied by a component, or proved below.

With 20 bands of 4 rows a pair at the threshold 0.85 shares no band with probability
4e-7; signatures restrict which pairs are looked at and never decide a link.

Defined cases: null, empty and wordless texts have an empty set, form their own groups
and link with nothing (component_id is the row's own id); rows with equal ids count as
separate rows; a group's id is its smallest non-null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, materialise
from .graph import components
from .textarrays import chunks, mix64, releasing, releasing_groups, shingle_sets

BANDS, ROWS = 20, 4
SLOTS = BANDS * ROWS
#: Classes on the two sides of a compared block.
FEW, BLOCK = 32, 512
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, 1 << 12, dtype=np.uint64) * _GOLD
_BAND = np.random.default_rng(73).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def superminhash(elements: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature of a set of 64-bit hashes.

    Element ``e`` draws, step by step, a random permutation of the slots and offers slot
    ``p[j]`` the value ``j + u``.  All elements take step ``j`` together; the loop stops
    early when every slot holds less than ``j``, since later offers are at least ``j``.
    """
    h = np.full(m, np.inf)
    n = len(elements)
    if not n:
        return h
    rows, order = np.arange(n), None
    for j in range(m):
        if j and h.max() < j:
            break
        draw = mix64(elements + _STEPS[j])
        value = (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + j
        pick = j + (((mix64(draw) >> np.uint64(32)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            first, slot = pick, pick
        else:
            if order is None:  # the permutations so far: slots 0 and first[i] swapped
                order = np.tile(np.arange(m, dtype=np.uint16), (n, 1))
                order[rows, first], order[:, 0] = 0, first
            slot = order[rows, pick].copy()
            order[rows, pick] = order[:, j]
            order[:, j] = slot
        np.minimum.at(h, slot, value)
    return h


def band_keys(signature: np.ndarray) -> np.ndarray:
    values = signature.view(np.uint64).reshape(BANDS, ROWS)
    return mix64((values * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def set_identity(elements: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    a, b = mix64(elements ^ _GOLD), mix64(elements + _GOLD)
    return np.array([a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)], np.uint64).tobytes()


def _signatures(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, bands = [], [], []
            for _, _, data, offsets in chunks(batch.column(batch.num_columns - 1)):
                for s in shingle_sets(data, offsets, k, lower):
                    sizes.append(len(s))
                    ids.append(set_identity(s) if len(s) else None)
                    bands.append(band_keys(superminhash(s)) if len(s) else None)
            columns = batch.columns[:-1] + [
                pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n", "set_id", "bands"])
    return run


def _sets(k: int, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                sets = shingle_sets(data, offsets, k, lower)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_identity(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["set_id", "shingles"])
    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            sets = [np.frombuffer(v.as_buffer(), np.int64) for v in part.column("shingles")]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [part.column("set_id").take(pa.array(owner)), pa.array(np.concatenate(sets))], ["set_id", "token"])


def _can_reach(inter: Column, a: Column, b: Column, percent: int) -> Column:
    """Could sets of sizes a and b with at most ``inter`` common elements be linked?"""
    return 100 * inter >= percent * (a + b - inter)


def _able(members: DataFrame, percent: int) -> DataFrame:
    """The members (key, set_id, n, common) that could be linked with the smallest class of their bucket."""
    least = members.groupBy("key").agg(F.min("n").alias("least_n"))
    partner = F.greatest(F.col("least_n"), F.col("common"))
    return members.join(least, "key").filter(_can_reach(F.col("common"), F.col("n"), partner, percent)).select("key", "set_id", "n", "common")


def links(pairs: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose full sets reach the similarity."""
    a = shingles.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa"))
    b = shingles.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(
        releasing(_verify(percent)), "a binary, b binary")


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members (key, set_id, ...) with their root, of the buckets that lie in several components."""
    placed = members.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    several = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    return placed.join(several, "key")


def _compare_blocks(percent: int):
    """A block of apart classes against a block of their cluster: links by counting common shingles."""
    def run(few: pa.Table, many: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if few.num_rows and many.num_rows:
            x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in t.column(c).combine_chunks()]
                    for t, c in ((few, "shingles"), (many, "shingles_m")))
            nx, ny = np.array([len(s) for s in x]), np.array([len(s) for s in y])
            tokens, owner = np.concatenate(x), np.repeat(np.arange(len(x)), nx)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            ids = [few.column("set_id").to_pylist(), many.column("set_id_m").to_pylist()]
            for j, s in enumerate(y):
                lo, hi = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
                found = np.repeat(lo, hi - lo) + np.arange((hi - lo).sum()) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
                common = np.bincount(owner[found], minlength=len(x))
                for i in np.flatnonzero(100 * common >= percent * (nx + ny[j] - common)):
                    if ids[0][i] != ids[1][j]:
                        out_a.append(min(ids[0][i], ids[1][j]))
                        out_b.append(max(ids[0][i], ids[1][j]))
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})
    return run


def _across(apart: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components that share a bucket.

    Buckets that share a class form a cluster.  The classes outside a cluster's largest
    component are compared with all of the cluster, block by block; only links come out.
    """
    first = apart.groupBy("key").agg(F.min("set_id").alias("b"))
    cluster = components(apart.join(first, "key").select(F.col("set_id").alias("a"), "b").distinct(), "near-clusters")
    placed = materialise(apart.select("set_id", "root").distinct().join(cluster.withColumnRenamed("node", "set_id").withColumnRenamed(
        "root", "cluster"), "set_id"), "near-clustered")
    main = placed.groupBy("cluster", "root").agg(F.count("*").alias("size")).groupBy("cluster").agg(
        F.max(F.struct("size", "root")).alias("m"), F.sum("size").alias("total"))
    main = main.select("cluster", F.col("m.root").alias("main"), F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"),
                       F.greatest(F.lit(1), F.ceil((F.col("total") - F.col("m.size")) / FEW)).cast("int").alias("fews"))
    ready = placed.join(main, "cluster").join(shingles, "set_id")
    at = F.xxhash64("set_id")
    few = ready.filter(F.col("root") != F.col("main")).select(
        "cluster", "set_id", "shingles", F.pmod(at, F.col("fews")).cast("int").alias("few"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    many = ready.select("cluster", "set_id", "shingles", F.explode(F.sequence(F.lit(0), F.col("fews") - 1)).alias("few"),
                        F.pmod(at, F.col("blocks")).cast("int").alias("block"))
    many = many.toDF("cluster_m", "set_id_m", "shingles_m", "few_m", "block_m")
    return few.groupBy("cluster", "few", "block").cogroup(many.groupBy("cluster_m", "few_m", "block_m")).applyInArrow(releasing_groups(_compare_blocks(percent)), "a binary, b binary").distinct()


def _with_links(roots: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """The components after further links (a, b)."""
    more = materialise(more, name)
    if more.isEmpty():
        return roots
    return materialise(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)), f"{name}-roots")


def group_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                          percent: int = 80, lower: bool = True) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Links: 100 * common shingles >= percent * union.  kept: the row's id is its component's.
    """
    return _grouped(df, id_col, text_col, k, percent, lower).select("id", "n_shingles", "component_id", "kept")


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                     lower: bool = True) -> DataFrame:
    """The rows of ``df`` without all but one of each group (of rows without words, all stay).

    The row with the group's id stays; of several, the one with the least text hash.
    """
    grouped = _grouped(df, id_col, text_col, k, percent, lower)
    keepers = materialise(grouped.filter("n_shingles > 0 AND kept").groupBy("root").agg(
        F.min(F.struct("text_key", "id")).alias("m"), F.count("*").alias("rows")).select(
            F.col("m.text_key").alias("__key"), F.col("m.id").alias("__id"), "rows"), "near-keepers")
    text = F.coalesce(F.col(text_col), F.lit(""))
    wordy, rest = df.filter(text.rlike(WORD)), df.filter(~text.rlike(WORD))
    some = wordy.withColumn("__text_key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    some = some.join(broadcast_if_small(keepers.select("__key", "__id")),
                     (F.col("__text_key") == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    if not keepers.filter("rows > 1").isEmpty():  # rows equal in id and text are one document twice
        some = some.dropDuplicates([id_col, "__text_key"])
    return some.select(*df.columns).unionByName(rest)


def _grouped(df: DataFrame, id_col: str, text_col: str, k: int, percent: int, lower: bool) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("t"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = materialise(rows.mapInArrow(
        releasing(_signatures(k, lower)), f"id {id_type}, text_key bigint, n bigint, set_id binary, bands array<bigint>"), "near-signatures")

    # one class per distinct set
    classes = signed.filter("n > 0").groupBy("set_id").agg(
        F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    slots = classes.select("set_id", "text_key", "n", F.explode("bands").alias("key"))
    shared = slots.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialise(slots.join(shared, "key"), "near-members")
    # the hub of a bucket: the class that stands in the largest buckets
    score = members.groupBy("set_id").agg(F.sum("members").alias("score"))
    scored = members.join(score, "set_id")
    hubs = scored.groupBy("key").agg(F.min(F.struct(-F.col("score"), "set_id", "n")).alias("hub"))
    small, large = F.least("n", "hub.n"), F.greatest("n", "hub.n")
    star = (members.join(hubs, "key").filter((F.col("set_id") != F.col("hub.set_id")) & (100 * small >= percent * large))
            .select(F.least("set_id", "hub.set_id").alias("a"), F.greatest("set_id", "hub.set_id").alias("b")).distinct())

    wanted = members.groupBy("set_id").agg(F.first("text_key").alias("text_key")).select("text_key")
    chosen = rows.select("text_key", "t").join(broadcast_if_small(wanted), "text_key", "left_semi")
    one_each = chosen.groupBy("text_key").agg(F.min("t").alias("t")).select("t")
    shingles = materialise(one_each.mapInArrow(releasing(_sets(k, lower)), "set_id binary, shingles binary"), "near-sets")

    found = materialise(links(star, shingles, percent), "near-links")
    roots = materialise(components(found), "near-roots")

    # buckets that are still in several components and hold unverified pairs
    open_ = materialise(_open_members(members.filter("members > 2").select("key", "set_id", "n"), roots), "near-open")
    if not open_.isEmpty():
        tokens = shingles.join(open_.select("set_id").distinct(), "set_id", "left_semi").mapInArrow(
            releasing(_tokens), "set_id binary, token bigint")
        own = tokens.groupBy("token").agg(F.count("*").alias("c"), F.min("set_id").alias("set_id")).filter("c = 1")
        own = own.groupBy("set_id").agg(F.count("*").alias("own"))
        able = _able(open_.join(own, "set_id", "left").withColumn("common", F.col("n") - F.coalesce("own", F.lit(0))), percent)
        apart = materialise(_open_members(able, roots), "near-apart")
        roots = _with_links(roots, _across(apart, shingles, percent), "near-more-links")

    # the smallest id of each component
    of_set = signed.filter("n > 0").groupBy("set_id").agg(F.min("id").alias("id"))
    tops = (of_set.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
            .withColumn("root", F.coalesce("root", "set_id")))
    least = tops.groupBy("root").agg(F.min("id").alias("component_id"))
    labels = tops.select("set_id", "root").join(least, "root")
    out = signed.select("id", "text_key", F.col("n").alias("n_shingles"), "set_id").join(labels, "set_id", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "text_key", "n_shingles", "root", component.alias("component_id")).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id")))
