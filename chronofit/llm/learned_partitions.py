"""Nearest neighbours by largest inner product through learned partitions.

* Equal vectors are one class with its smallest ids; no more of them can be among the nearest.
* On a bounded sample of classes (``SAMPLE``) a neighbour graph is cut into balanced parts:
  bisected again and again along its slowest mode, with swaps that lower the cut.
* A small network with one hidden layer learns, from a vector's direction, its own part and the share
  of its nearest neighbours in every part.
* Every class is placed in its most probable part.  A query goes to the parts, most probable
  first, until they hold ``MASS`` of its expected neighbours, and is compared with all classes
  there in double precision.  Queries that found too few go to all parts.

The graph and the network are fitted in one task on the sample alone; everything else is
spread over parts, which are cut into blocks of bounded size on both sides, so a crowded part
is many groups.

Defined cases: vectors that are null, empty, all zero, hold a null or a non-finite number, or have
another length than most (ties: the shorter) take no part; rows with a null id neither;
repeated rows count once for each id; ties go to the smaller id; with fewer candidates than
asked for, all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise
from .textarrays import releasing, releasing_groups

TOP = 20
#: Classes that the graph and the network are fitted on.
SAMPLE = 16_384
#: Classes that a part should have, and the most parts (each has at least 64 of the sample).
PART_ROWS, MAX_PARTS = 2048, 256
#: Expected share of a query's neighbours in the parts it goes to, and the fewest parts.
MASS, LEAST_PARTS = 0.97, 2
#: Neighbours in the graph.
DEGREE = 12
HIDDEN, EPOCHS, BATCH, RATE = 128, 40, 256, 3e-3
#: Classes and queries that one group compares.
CLASS_BLOCK, QUERY_BLOCK = 16_384, 4096


def nearest_in(x: np.ndarray, k: int, step: int = 512) -> np.ndarray:
    """Rows of the ``k`` largest inner products of each row of ``x`` with the others."""
    out = np.zeros((len(x), k), np.int64)
    for lo in range(0, len(x), step):
        near = x[lo:lo + step] @ x.T
        near[np.arange(len(near)), np.arange(lo, lo + len(near))] = -np.inf
        out[lo:lo + step] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int, seed: int = 5, steps: int = 80, rounds: int = 12) -> np.ndarray:
    """Parts (a power of two, equal in size up to one a bisection) of the symmetric neighbour graph."""
    n, dice = len(near), np.random.default_rng(seed)
    own = np.repeat(np.arange(n), near.shape[1])
    both = np.unique(np.concatenate([own * n + near.ravel(), near.ravel() * n + own]))
    u, v = np.divmod(both, n)
    label = np.zeros(n, np.int64)
    while label.max() + 1 < parts:
        inside = label[u] == label[v]
        u, v = u[inside], v[inside]
        groups = int(label.max()) + 1
        degree = np.bincount(u, minlength=n) + 1.0
        mass = np.bincount(label, degree, groups)
        mode = dice.standard_normal(n)
        for _ in range(steps):  # lazy random walk: what fades last, besides the constant, tells the two halves apart
            mode -= (np.bincount(label, mode * degree, groups) / mass)[label]
            mode = (mode + (np.bincount(u, mode[v], n) + mode) / degree) / 2
            mode /= np.sqrt(np.bincount(label, mode * mode, groups) + 1e-300)[label]
        order = np.lexsort((mode, label))
        size = np.bincount(label, minlength=groups)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        side = (place >= (size[label] + 1) // 2).astype(np.int64)
        for r in range(rounds):  # swap pairs that lower the cut, a random half of them at once
            across = np.bincount(u, side[u] != side[v], n)
            gain = 2 * across - np.bincount(u, minlength=n) + dice.random(n) * 1e-3
            order = np.lexsort((-gain, side, label))
            key = label[order] * 2 + side[order]
            first = np.searchsorted(key, np.arange(2 * groups))
            count = np.bincount(key, minlength=2 * groups).reshape(groups, 2)
            swaps = []
            for g in range(groups):
                a, b = order[first[2 * g]:][:count[g].min()], order[first[2 * g + 1]:][:count[g].min()]
                good = (gain[a] + gain[b] > 0.01) & (dice.random(len(a)) < 0.5)
                swaps += [a[good], b[good]]
            moved = np.concatenate(swaps)
            if not len(moved) and r:
                break
            side[moved] = 1 - side[moved]
        label = 2 * label + side
    return label


class Router:
    """One hidden layer over a vector's direction; one head for its own part, one for its neighbours' parts."""

    names = ("w", "b", "w_place", "b_place", "w_route", "b_route")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fit(cls, x: np.ndarray, part: np.ndarray, share: np.ndarray, seed: int = 6) -> "Router":
        """``part``: own parts; ``share``: neighbours' share of every part.  Adam on the two cross entropies."""
        dice, parts = np.random.default_rng(seed), share.shape[1]
        x = _directions(x).astype(np.float32)
        w = {"w": dice.standard_normal((x.shape[1], HIDDEN)) * 1.4, "b": np.zeros(HIDDEN), "w_place": dice.standard_normal((HIDDEN, parts)) * 0.1,
             "b_place": np.zeros(parts), "w_route": dice.standard_normal((HIDDEN, parts)) * 0.1, "b_route": np.zeros(parts)}
        w = {k: a.astype(np.float32) for k, a in w.items()}
        first, second = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
        hard, share, t = np.eye(parts, dtype=np.float32)[part], share.astype(np.float32), 0
        for epoch in range(EPOCHS):
            order = dice.permutation(len(x))
            rate = RATE * (1 - epoch / EPOCHS)
            for lo in range(0, len(x), BATCH):
                rows = order[lo:lo + BATCH]
                h = np.maximum(x[rows] @ w["w"] + w["b"], 0)
                d_place = (_softmax(h @ w["w_place"] + w["b_place"]) - hard[rows]) / len(rows)
                d_route = (_softmax(h @ w["w_route"] + w["b_route"]) - share[rows]) / len(rows)
                d_h = (d_place @ w["w_place"].T + d_route @ w["w_route"].T) * (h > 0)
                slope = {"w": x[rows].T @ d_h, "b": d_h.sum(0), "w_place": h.T @ d_place, "b_place": d_place.sum(0),
                         "w_route": h.T @ d_route, "b_route": d_route.sum(0)}
                t += 1
                for k, g in slope.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    w[k] -= rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        return cls(w)

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(_directions(x).astype(np.float32) @ self.weights["w"] + self.weights["b"], 0)

    def place(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(self._hidden(x) @ self.weights["w_place"] + self.weights["b_place"], axis=1)

    def route(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self._hidden(x) @ self.weights["w_route"] + self.weights["b_route"])

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.weights)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> "Router":
        with np.load(io.BytesIO(blob)) as f:
            return cls({k: f[k] for k in cls.names})


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that squares of very large or small numbers stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _matrix(column) -> np.ndarray:
    """A column of equally long lists of doubles as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_router(x: np.ndarray, parts: int) -> Router:
    """Neighbour graph of directions, its balanced parts, and the network that learns them."""
    unit = _directions(x).astype(np.float32)
    part = balanced_parts(nearest_in(unit, min(DEGREE, len(x) - 1)), parts)
    scale = float(np.abs(x).max())
    near = nearest_in((x / scale).astype(np.float32), min(TOP, len(x) - 1))  # by inner product, as it is asked for
    share = np.zeros((len(x), parts))
    np.add.at(share, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    return Router.fit(x, part, share)


def _fit(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column("class"), _matrix(b.column("vec"))) for b in batches if len(b)]
        if rows:
            names = np.concatenate([np.asarray(c.to_numpy()) for c, _ in rows])
            x = np.concatenate([m for _, m in rows])[np.argsort(names, kind="stable")]
            yield pa.RecordBatch.from_arrays([pa.array([fit_router(x, parts).save()], pa.binary())], ["model"])
    return run


def _place(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router.load(model)
        for b in batches:
            if len(b):
                part = router.place(_matrix(b.column("vec"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), *b.columns], ["part", *b.schema.names])
    return run


def _route(model: bytes, mass: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = Router.load(model)
        for b in batches:
            if len(b):
                p = router.route(_matrix(b.column("vec")))
                order = np.argsort(-p, axis=1, kind="stable")
                before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
                go = (before < mass) | (np.arange(p.shape[1]) < least)
                row = pa.array(np.nonzero(go)[0])
                yield pa.RecordBatch.from_arrays([pa.array(order[go].astype(np.int32)), *(c.take(row) for c in b.columns)], ["part", *b.schema.names])
    return run


def _compare(top: int, step: int = 256):
    """Queries of a group against its classes: the ``top`` nearest ids of each."""
    def run(classes: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if len(classes) and len(queries):
            c, q = _matrix(classes.column("to")), _matrix(queries.column("vec"))
            ids = classes.column("ids").to_pylist()
            least = np.array([own[0] for own in ids])
            names = queries.column("class").to_pylist()
            with np.errstate(over="ignore", invalid="ignore"):
                for lo in range(0, len(q), step):
                    near = q[lo:lo + step] @ c.T
                    # one more place in the rough order for each that rounding could swap
                    cut = min(len(c), 2 * top)
                    rough = np.argpartition(-near, cut - 1, axis=1)[:, :cut]
                    exact = np.zeros(rough.shape)
                    for j in range(c.shape[1]):
                        exact += q[lo:lo + step, j, None] * c[rough, j]
                    for i, (own, score) in enumerate(zip(rough, exact)):
                        order = np.lexsort((least[own], -score))[:top]
                        pairs = sorted((-s, i2) for s, k in zip(score[order].tolist(), own[order].tolist()) for i2 in ids[k])[:top]
                        found[0].extend([names[lo + i]] * len(pairs))
                        found[1].extend(-s for s, _ in pairs)
                        found[2].extend(i2 for _, i2 in pairs)
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.int64())],
                        names=["class", "score", "vec_id"])
    return run


def _blocks(df: DataFrame, size: int) -> DataFrame:
    """``(part, blocks)``: how many blocks of about ``size`` rows each part is cut into (a row a part)."""
    return df.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))


def _searched(placed: DataFrame, routed: DataFrame, top: int) -> DataFrame:
    """Nearest ids of every routed query class as a sorted array of (score, vec_id)."""
    of_classes = F.broadcast(_blocks(placed, CLASS_BLOCK).withColumnRenamed("blocks", "class_blocks"))  # MAX_PARTS rows at most
    of_queries = F.broadcast(_blocks(routed, QUERY_BLOCK).withColumnRenamed("blocks", "query_blocks"))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def salted(n: str):
        return F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    left = placed.join(of_classes, "part").join(of_queries, "part").withColumn("cb", salted("class_blocks")).withColumn("qb", every("query_blocks"))
    right = routed.join(of_classes, "part").join(of_queries, "part").withColumn("qb", salted("query_blocks")).withColumn("cb", every("class_blocks"))
    pairs = left.select("part", "cb", "qb", F.col("vec").alias("to"), "ids").groupBy("part", "cb", "qb").cogroup(
        right.select(*[(F.col(c) + 0).cast("int").alias(f"to_{c}") for c in ("part", "cb", "qb")], "class", "vec").groupBy("to_part", "to_cb", "to_qb")).applyInArrow(
        releasing_groups(_compare(top)), "class bigint, score double, vec_id bigint")
    order = Window.partitionBy("class").orderBy(F.desc("score"), F.asc("vec_id"))
    best = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= top)
    return best.groupBy("class").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id"))).alias("near"))  # top entries


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part, vec in doubles."""
    raw = F.col(vector_col)
    vec = F.transform(raw, lambda x: x.cast("double"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & raw.isNotNull() & finite & F.exists(vec, lambda x: x != 0)).distinct()
    size = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).select("size").scalar()
    return rows.filter(F.size("vec") == size)


def search(df: DataFrame, every: int = 20, top: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding",
           mass: float = MASS, least: int = LEAST_PARTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows whose id is divisible by ``every``, against all other rows."""
    rows = materialise(usable(df, id_col, vector_col), "ann-rows")
    small = Window.partitionBy("vec").orderBy("vec_id")
    firsts = rows.withColumn("n", F.row_number().over(small)).filter(F.col("n") <= top + 1)
    classes = materialise(firsts.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("class"), "vec", "ids"), "ann-classes")  # top + 1 ids at most
    queries = rows.filter(F.col("vec_id") % every == 0)
    members = materialise(queries.select(F.col("vec_id").alias("query_id"), "vec").join(classes.select("class", "vec"), "vec").select("query_id", "class"), "ann-queries")
    asked = classes.select("class", "vec").join(members.select("class").distinct(), "class", "left_semi")

    n = classes.count()
    parts = 1 << max(0, min(n // PART_ROWS, MAX_PARTS).bit_length() - 1)
    if parts == 1:
        placed, routed = classes.withColumn("part", F.lit(0)), asked.withColumn("part", F.lit(0))
    else:
        sample = classes.select("class", "vec").orderBy(F.xxhash64("class"), "class").limit(SAMPLE)
        model = materialise(sample.coalesce(1).mapInArrow(releasing(_fit(parts)), "model binary"), "ann-model").first()["model"]
        placed = materialise(classes.mapInArrow(releasing(_place(model)), "part int, class bigint, vec array<double>, ids array<bigint>"), "ann-placed")
        routed = materialise(asked.mapInArrow(releasing(_route(model, mass, least)), "part int, class bigint, vec array<double>"), "ann-routed")
    found = materialise(_searched(placed, routed, top + 1), "ann-found")
    if parts > 1:
        short = asked.join(found.filter(F.size("near") > top).select("class"), "class", "left_anti")
        short = materialise(short.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "class", "vec"), "ann-short")
        if not short.isEmpty():
            rest = _searched(placed, short, top + 1)
            found = found.join(short.select("class").distinct(), "class", "left_anti").union(rest)
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    out = members.join(broadcast_if_small(found, limit=50_000), "class").select("query_id", F.posexplode(near).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.low")).alias("score"))
