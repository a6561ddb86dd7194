"""Tree ensembles for absolute error: boosting with leaf medians, and a quantile forest (M2-M4).

``AbsoluteBoost`` starts from the label's median.  Each round grows a regression tree on the
signs of the residuals, routes the rows to its leaves, gives every leaf the median of its
rows' residuals and adds a step of it.  The median is an actual residual and exact
(``exact_ranked``): tasks send a few sorted values of each leaf, which bound it, and in a second pass,
if they leave it open, the values within the bounds.

The features are cut into bins once per ensemble, not once per round, at thresholds chosen
like spark.ml's; the trees split like spark.ml's as well.  Rows are stored in blocks of bins
(a byte a feature), so that a level of a tree is one pass of counting bins in the tasks,
whose counts Spark adds up.  Models on the same rows share the blocks and grow side by side
(``fit_many``), each with its own features and parameters, so a pass serves a level of all.

``QuantileForest`` grows a random forest and stores, for each (tree, leaf), the quantiles of
its rows' labels, found like the medians.  A prediction is the median of what the row's leaves hold,
each tree with the same weight; the stored table is bounded by trees x leaves x ``LEAF_QUANTILES`` and
travels with the scoring function, so scoring moves no rows.

The blocks lie in a written table, renewed with the predictions every ``CUT_ROUNDS`` rounds;
between, tasks add the trees grown since.  Nothing is held in an executor.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..llm.common import bound_batches
from ..sources.sinks import output_dir, write_table
from .lookup import stored_table

ACCURACY = 100_000
LEAF_QUANTILES = 31
CUT_ROUNDS = 10
#: Values that a task sorts by group at a time, and the sorted values that it sends of a group's first.
CHUNK_ROWS = 1 << 21
MEDIAN_POINTS = 512
LEAF_POINTS = 1 << 13
#: Blocks of a file: files small enough to be dealt evenly to the cores.
FILE_BLOCKS = 8
#: Rows of a forest's predictions made at a time.
SCORED_ROWS = 1 << 10
#: Bins of a feature, and the rows whose values set their thresholds (spark.ml's defaults).
BINS = 32
THRESHOLD_ROWS = 10_000
#: Up to this many nodes a tree is applied from its leaves, beyond from its root.
FEW_NODES = 127
_TREE = ("maxDepth", "minInstancesPerNode", "maxBins")


def _runs(sorted_groups: np.ndarray):
    """(group, its slice) of sorted group numbers."""
    ends = np.append(np.flatnonzero(np.diff(sorted_groups)), len(sorted_groups) - 1) + 1 if len(sorted_groups) else []
    for first, end in zip([0, *ends[:-1]], ends):
        yield int(sorted_groups[first]), slice(first, end)


def _merged(parts: DataFrame, columns: Sequence[str], answer) -> list:
    """``(key, *answer(key, the other columns of its rows))`` for every key of ``parts``: the rows of a key meet in one task, which
    passes over them.  An answer has a list of doubles for each of ``columns``."""
    def merge(batches):
        now, rows, ended = None, [], []

        def answers():
            return pa.RecordBatch.from_pydict({name: [row[i] for row in ended] for i, name in enumerate(("key", *columns))})
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and key != now:
                    ended.append((now, *answer(now, zip(*rows))))
                    rows = []
                now = key
                rows.append(row)
            if ended:
                yield answers()
                ended = []
        if rows:
            ended.append((now, *answer(now, zip(*rows))))
            yield answers()
    schema = ", ".join(["key bigint", *[f"{c} array<double>" for c in columns]])
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(merge, schema).collect()


def _chunks(batches, sets):
    """The (groups, values) of each set, in chunks of about ``CHUNK_ROWS`` values of all sets."""
    held, rows = {}, 0
    for batch in batches:
        for pairs in sets(batch):
            for k, pair in pairs:
                held.setdefault(k, []).append(pair)
                rows += len(pair[1])
            if rows >= CHUNK_ROWS:
                yield held
                held, rows = {}, 0
    if held:
        yield held


def _sorted_groups(held):
    """(set, group, its sorted values) of a chunk."""
    for k, pairs in held.items():
        groups, values = (np.concatenate(column) for column in zip(*pairs))
        order = np.argsort(groups, kind="stable")  # a radix sort of small numbers
        groups, values = groups[order], values[order]
        for group, at in _runs(groups):
            yield k, group, np.sort(values[at])


def _even_ranks(n: int, points: int) -> np.ndarray:
    """Up to ``points`` of the ranks 0, 1, ..., n - 1, the first and the last among them."""
    return np.arange(n) if n <= points else np.unique(np.rint(np.linspace(0, n - 1, points)).astype(np.int64))


def exact_ranked(table: DataFrame, sets, probs: Sequence[float], points: int) -> dict[tuple[int, int], list[float]]:
    """For every (set, group) the values at ranks ceil(p n) of its n, for the p of ``probs``: actual values, those of
    ``percentile_approx`` where it is exact.

    ``sets(batch)`` yields lists of (set, (groups, values)), the groups as small integers.  First the tasks send, per chunk of
    rows and group, up to ``points`` sorted values at even ranks, which bound every wanted one.  Where a bound is
    open, the values within it are sent and counted.  The result, a list for each group, is the driver's."""
    probs = np.asarray(probs, dtype=float)

    def wanted(n):
        return np.clip(np.ceil(probs * n).astype(np.int64), 1, n)

    def sketches(batches):
        for held in _chunks(batches, sets):
            found = [(k << 32 | group, len(v), v[_even_ranks(len(v), points)].tobytes()) for k, group, v in _sorted_groups(held)]
            yield pa.RecordBatch.from_pydict(dict(zip(("key", "n", "points"), zip(*found))))

    def bounds(_, columns):
        sizes, held = columns
        ranks = [_even_ranks(n, points) for n in sizes]
        values = np.concatenate([np.frombuffer(v) for v in held])
        order = np.argsort(values)
        values, need = values[order], wanted(sum(sizes))
        least = np.cumsum(np.concatenate([np.diff(r, prepend=-1) for r in ranks])[order])  # rows up to a value, at least
        most = np.cumsum(np.concatenate([np.diff(r, append=r[-1] + 1) for r in ranks])[order])
        return [values[np.searchsorted(upto, need)].tolist() for upto in (most, least)]
    found, ends = {}, {}
    for key, lo, hi in _merged(table.mapInArrow(sketches, "key bigint, n bigint, points binary"), ("lo", "hi"), bounds):
        found[key] = lo
        if open_ := [(i, a, b) for i, (a, b) in enumerate(zip(lo, hi)) if a < b]:
            ends[key] = open_
    if ends:
        many = len(probs)

        def within(batches):
            for held in _chunks(batches, sets):
                sent = []
                for k, group, v in _sorted_groups(held):
                    for i, lo, hi in ends.get(k << 32 | group, ()):
                        first, end = np.searchsorted(v, lo), np.searchsorted(v, hi, "right")
                        distinct, counts = np.unique(v[first:end], return_counts=True)
                        sent.append(((k << 32 | group) * many + i, len(v), int(first), distinct.tobytes(), counts.astype(np.int64).tobytes()))
                if sent:
                    yield pa.RecordBatch.from_pydict(dict(zip(("key", "n", "before", "inside", "counts"), zip(*sent))))

        def chosen(key, columns):
            sizes, before, inside, counts = columns
            values, counts = (np.concatenate([np.frombuffer(v, dtype=kind) for v in column]) for column, kind in ((inside, np.float64), (counts, np.int64)))
            order = np.argsort(values)
            need = wanted(sum(sizes))[key % many] - sum(before)
            return [[float(values[order][np.searchsorted(np.cumsum(counts[order]), need)])]]
        for key, (value,) in _merged(table.mapInArrow(within, "key bigint, n bigint, before bigint, inside binary, counts binary"), ("value",), chosen):
            found[key // many][key % many] = value
    return {(key >> 32, key & (1 << 32) - 1): list(values) for key, values in found.items()}


def _thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins - 1`` thresholds halfway between neighbouring values, at even steps of rank (as spark.ml takes them)."""
    distinct, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    stride, found = len(values) / bins, []
    upto = np.cumsum(counts)
    for before, after, middle in zip(upto[:-1], upto[1:], middles):
        target = stride * (len(found) + 1)
        if abs(before - target) < abs(after - target):
            found.append(middle)
    return np.array(found)


@dataclass
class Tree:
    """Nodes of a tree, the root first: an inner node sends values up to ``cut`` to ``left`` and others to ``left + 1``;
    the leaf with number i has the feature -1 - i."""

    feature: list[int]
    cut: list[float]
    left: list[int]
    depth: int

    def picker(self, labels, columns=None):
        """A function from values (features x rows) to the label of each row's node; it travels to the tasks by value.
        ``columns``: the rows of the values that hold the tree's features, if not 0, 1, ..."""
        few, depth = len(self.feature) <= FEW_NODES, self.depth
        labels, cut, left = np.array(labels, dtype=np.int8 if few else np.int64), np.array(self.cut), np.array(self.left)
        feature = np.array([j if j < 0 or columns is None else columns[j] for j in self.feature])

        def from_leaves(values):  # a comparison and a choice per inner node; children stand behind their parent
            found, cuts = dict(enumerate(labels)), cut.astype(values.dtype)
            for node in reversed(np.flatnonzero(feature >= 0)):
                chosen = -(values[feature[node]] <= cuts[node]).view(np.int8)  # all bits, or none; a NaN goes right
                right = found[left[node] + 1]
                found[node] = right ^ ((found[left[node]] ^ right) & chosen)
            return np.broadcast_to(found[0], values.shape[1])

        def from_root(values):  # a step per level
            at, rows = np.zeros(values.shape[1], dtype=np.int64), np.arange(values.shape[1])
            for _ in range(depth):
                inner = feature[at] >= 0
                right = ~(values[np.maximum(feature[at], 0), rows] <= cut[at])
                at = np.where(inner, left[at] + right, at)
            return labels[at]
        return from_leaves if few else from_root

    def leaf_picker(self, columns=None):
        return self.picker([max(-1 - j, 0) for j in self.feature], columns)


@dataclass
class Blocks:
    """Training rows in blocks, as bytes: the bins of their features (features x rows) and labels; any number of models
    is fitted on them."""

    table: DataFrame
    thresholds: list[np.ndarray]
    bins: int
    base: float | None  # the median label; None without rows

    @classmethod
    def of(cls, rows: DataFrame, label: str, seed: int, bins: int = BINS) -> "Blocks":
        """``rows``: stored rows with the vector ``__x`` and ``label``."""
        bound_batches(rows.sparkSession)
        rows = rows.select(vector_to_array("__x").alias("__x"), F.col(label).cast("double").alias("__y"))
        base, n = rows.agg(F.percentile_approx("__y", 0.5, ACCURACY), F.count(F.lit(1))).first()
        if base is None:
            return cls(rows, [], bins, None)
        bins = min(bins, n)
        share = max(bins * bins, THRESHOLD_ROWS) / n
        some = np.array((rows.sample(share, seed) if share < 1 else rows).select("__x").toArrow()["__x"].to_pylist(), dtype=float)
        thresholds = [_thresholds(column, bins) for column in some.T]
        table = _stored_blocks(_binned(rows, thresholds))
        return cls(table, thresholds, bins, float(base))

    @property
    def kind(self):
        return _kind(self.thresholds)


def _kind(thresholds: list[np.ndarray]):
    return np.uint8 if max(map(len, thresholds)) < 256 else np.uint16


def _stored_blocks(blocks: DataFrame) -> DataFrame:
    return write_table(blocks, output_dir(blocks.sparkSession, "boost_rows"), maxRecordsPerFile=FILE_BLOCKS)


def _binned(rows: DataFrame, thresholds: list[np.ndarray]) -> DataFrame:
    kind = _kind(thresholds)

    def blocks(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                bins = np.stack([np.searchsorted(cuts, x[:, j]).astype(kind) for j, cuts in enumerate(thresholds)])
                y = batch.column(1).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({"x": [bins.tobytes()], "y": [y.tobytes()]})
    return rows.mapInArrow(blocks, "x binary, y binary")


def _reader(blocks: Blocks, grown: list[list]):
    """A function from a batch to its blocks' (bins, labels, predictions of the ``wanted`` models), after the trees
    ``grown`` of each since the blocks were written."""
    features, kind, base, models = len(blocks.thresholds), blocks.kind, blocks.base, len(grown)

    def read(batch, wanted):
        for x, y, *f in zip(*(c.to_pylist() for c in batch.columns)):
            bins, labels = np.frombuffer(x, dtype=kind).reshape(features, -1), np.frombuffer(y)
            before, now = np.frombuffer(f[0]).reshape(models, -1) if f else np.full((models, len(labels)), base), {}
            for k in wanted:
                now[k] = before[k]
                for leaf_of, steps in grown[k]:
                    now[k] = now[k] + steps[leaf_of(bins)]
            yield bins, labels, now
    return read


def _histograms(table: DataFrame, read, asked: list[tuple], bins: int) -> list[np.ndarray]:
    """For every (model, its features' places, tree, nodes) of ``asked`` its rows per (node, feature, sign of the residual,
    bin): counted in the tasks, added up by Spark in one job."""
    plans, shapes = [], []
    for k, columns, tree, nodes in asked:
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        plans.append((k, columns, tree.picker(slot, columns), len(nodes) * 3 * bins))
        shapes.append((len(columns), len(nodes), 3, bins))
    models = [k for k, *_ in plans]

    def count(batches):
        totals = [np.zeros((len(columns), cells), dtype=np.int64) for _, columns, _, cells in plans]
        for batch in batches:
            for x, y, now in read(batch, models):
                for total, (k, columns, pick, cells) in zip(totals, plans):
                    at, rest = pick(x), y - now[k]
                    first = (at.astype(np.int64) * 3 + 1 + ((rest > 0).view(np.int8) - (rest < 0).view(np.int8))) * bins
                    inside = None if (at >= 0).all() else np.flatnonzero(at >= 0)
                    first = first if inside is None else first[inside]
                    for row, j in zip(total, columns):
                        row += np.bincount(first + (x[j] if inside is None else x[j].take(inside)), minlength=cells)
        total = np.concatenate([t.ravel() for t in totals])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": found, "n": total[found]})
    sums = table.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # models x nodes x features x bins x 3
    out = np.zeros(sum(map(math.prod, shapes)))
    out[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    parts = np.split(out, np.cumsum([math.prod(shape) for shape in shapes])[:-1])
    return [part.reshape(shape).transpose(1, 0, 2, 3) for part, shape in zip(parts, shapes)]


def _variance(n, total, squares):
    with np.errstate(all="ignore"):
        return np.where(n > 0, (squares - total * total / n) / n, 0.0)


def _growing(thresholds: list[np.ndarray], bins: int, max_depth: int, min_rows: int):
    """Grows a regression tree on the signs of the residuals, a level a pass: the split of the largest drop in variance, the
    first one if several are equal.  Yields (tree, nodes to count) and is sent their histograms; returns the tree with cuts
    between bins and with cuts between values."""
    tree, mean, nodes = Tree([-1], [0.0], [0], 0), [0.0], [(0, None, None)]
    splits = np.arange(bins - 1)[None, :] < np.array([len(t) for t in thresholds])[:, None]
    while nodes and tree.depth < max_depth and splits.any():
        counted = yield tree, [node for node, _, _ in nodes]
        others = [(other, parent - h) for (_, other, parent), h in zip(nodes, counted) if other is not None]
        nodes = [node for node, _, _ in nodes] + [other for other, _ in others]
        hist = np.stack([*counted, *(h for _, h in others)])
        upto = np.cumsum(hist, axis=3)
        n, total, squares = upto.sum(axis=2), upto[:, :, 2] - upto[:, :, 0], upto[:, :, 2] + upto[:, :, 0]
        (ln, rn), (lt, rt), (lq, rq) = [(v[:, :, :-1], v[:, :, -1:] - v[:, :, :-1]) for v in (n, total, squares)]
        li, ri = _variance(ln, lt, lq), _variance(rn, rt, rq)
        with np.errstate(all="ignore"):
            whole = ln + rn
            gain = _variance(n, total, squares)[:, :, -1:] - ln / whole * li - rn / whole * ri
        gain = np.where(splits & (ln >= min_rows) & (rn >= min_rows), gain, -np.inf)
        tree.depth, following = tree.depth + 1, []
        for k, node in enumerate(nodes):
            j, s = divmod(int(np.argmax(gain[k])), bins - 1)
            if not gain[k, j, s] > 0:
                continue
            tree.feature[node], tree.cut[node], tree.left[node] = j, s, len(tree.feature)
            parts = []
            for m, t, impurity in ((ln, lt, li), (rn, rt, ri)):
                if abs(impurity[k, j, s]) >= np.finfo(float).eps:
                    parts.append((m[k, j, s], len(tree.feature)))
                tree.feature.append(-1)
                tree.cut.append(0.0)
                tree.left.append(0)
                mean.append(t[k, j, s] / m[k, j, s])
            if parts:  # of two children the one of fewer rows is counted, the other is the rest of their parent
                (_, least), *rest = sorted(parts)
                following.append((least, rest[0][1] if rest else None, hist[k]))
        nodes = following
    for node in reversed(range(len(tree.feature))):  # equal sibling leaves are one
        left = tree.left[node]
        if tree.feature[node] >= 0 and tree.feature[left] < 0 and tree.feature[left + 1] < 0 and mean[left] == mean[left + 1]:
            tree.feature[node] = -1
    leaves, todo = 0, [0]
    while todo:
        node = todo.pop()
        if tree.feature[node] >= 0:
            todo += [tree.left[node] + 1, tree.left[node]]
        else:
            tree.feature[node], leaves = -1 - leaves, leaves + 1
    cuts = [float(thresholds[j][int(c)]) if j >= 0 else 0.0 for j, c in zip(tree.feature, tree.cut)]
    return tree, Tree(tree.feature, cuts, tree.left, tree.depth)


@dataclass
class AbsoluteBoost:
    base: float
    step: float
    trees: list[Tree]
    values: list[list[float]]  # of each tree's leaves

    @classmethod
    def fit(cls, data: DataFrame, label: str, params: dict, seed: int) -> "AbsoluteBoost":
        """``data`` has ``__x`` and ``label``; ``params``: maxIter, stepSize and tree parameters."""
        rows, _ = stored_table(data.select("__x", label), "boost_vectors")
        blocks = Blocks.of(rows, label, seed, int(params.get("maxBins", BINS)))
        return cls.fit_many(blocks, [(range(len(blocks.thresholds)), params)])[0]

    @classmethod
    def fit_many(cls, blocks: Blocks, asked: Sequence[tuple[Sequence[int], dict]]) -> "list[AbsoluteBoost]":
        """A model for each (places of its features, parameters), grown side by side: a level of all their trees is one pass,
        as are all their leaf medians.  Each is the model that it would be alone."""
        models = [cls(blocks.base or 0.0, float(params["stepSize"]), [], []) for _, params in asked]
        if blocks.base is None:
            return models
        table, grown = blocks.table, [[] for _ in asked]
        rounds = [int(params["maxIter"]) for _, params in asked]
        for r in range(max(rounds)):
            read, active = _reader(blocks, [list(g) for g in grown]), [k for k, n in enumerate(rounds) if r < n]
            trees = cls._grow(blocks, table, read, {k: asked[k] for k in active})
            leaf_of = {k: binned.leaf_picker(asked[k][0]) for k, (binned, _) in trees.items()}
            for k, values in cls._medians(table, read, leaf_of).items():
                models[k].trees.append(trees[k][1])
                models[k].values.append(values)
                grown[k].append((leaf_of[k], models[k].step * np.array(values)))
            if (r + 1) % CUT_ROUNDS == 0 and r + 1 < max(rounds):
                table = _stored_blocks(cls._brought_forward(table, _reader(blocks, grown), len(asked)))
                grown = [[] for _ in asked]
        return models

    @staticmethod
    def _grow(blocks: Blocks, table: DataFrame, read, asked: dict) -> dict[int, tuple[Tree, Tree]]:
        """The next tree of each model of ``asked``, all of them a level a pass."""
        growing = {k: _growing([blocks.thresholds[j] for j in columns], blocks.bins, int(params.get("maxDepth", 5)), int(params.get("minInstancesPerNode", 1)))
                   for k, (columns, params) in asked.items()}
        trees, counted = {}, dict.fromkeys(growing)
        while counted:
            todo = {}
            for k, found in counted.items():
                try:
                    todo[k] = growing[k].send(found)
                except StopIteration as end:
                    trees[k] = end.value
            wanted = [(k, list(asked[k][0]), tree, nodes) for k, (tree, nodes) in todo.items()]
            counted = dict(zip(todo, _histograms(table, read, wanted, blocks.bins))) if wanted else {}
        return dict(sorted(trees.items()))

    @staticmethod
    def _medians(table: DataFrame, read, leaf_of: dict) -> dict[int, list[float]]:
        """The medians of the residuals of every model's leaves."""
        def residuals(batch):
            for x, y, now in read(batch, list(leaf_of)):
                yield [(k, (pick(x), y - now[k])) for k, pick in leaf_of.items()]
        values = {k: [] for k in leaf_of}
        for (k, _), (v,) in sorted(exact_ranked(table, residuals, [0.5], MEDIAN_POINTS).items()):  # every leaf has rows
            values[k].append(v)
        return values

    @staticmethod
    def _brought_forward(table: DataFrame, read, models: int) -> DataFrame:
        def blocks(batches):
            for batch in batches:
                for x, y, now in read(batch, range(models)):
                    yield pa.RecordBatch.from_pydict({"x": [x.tobytes()], "y": [y.tobytes()], "f": [b"".join(now[k].tobytes() for k in range(models))]})
        return table.mapInArrow(blocks, "x binary, y binary, f binary")

    def variants(self):
        """A function from values and others' values (features x rows) to the prediction of the rows, then of each feature's
        variant, whose values of the feature are the others': (a feature or None, prediction).  Only trees that split by the
        feature are applied again."""
        trees = [(t.leaf_picker(), self.step * np.array(v), {j for j in t.feature if j >= 0}) for t, v in zip(self.trees, self.values)]
        base = self.base

        def total(n, parts):
            value = np.full(n, base)
            for part in parts:
                value = value + part
            return value

        def run(values, others):
            n = values.shape[1]
            own = [steps[leaf_of(values)] for leaf_of, steps, _ in trees]
            yield None, total(n, own)
            for j in range(len(values)):
                kept = values[j].copy()
                values[j] = others[j]
                yield j, total(n, [steps[leaf_of(values)] if j in used else part for (leaf_of, steps, used), part in zip(trees, own)])
                values[j] = kept
        return run

    def _scorer(self, kind: str, result):
        """``result`` of (leaves of a tree, its values times the step) for all trees, on batches of vectors."""
        trees = [(t.leaf_picker(), self.step * np.array(v)) for t, v in zip(self.trees, self.values)]

        def run(x: pa.Array) -> pa.Array:
            values = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1).T)
            return result(len(x), [(leaf_of(values), steps) for leaf_of, steps in trees])
        return F.arrow_udf(run, kind)(vector_to_array("__x"))

    def _leaves(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__leaf<k>``, the number of the row's leaf of tree k."""
        def leaves(n, routed):
            return pa.array([list(map(int, at)) for at in zip(*(leaf for leaf, _ in routed))], pa.list_(pa.int32()))
        at = df.withColumn("__leaves", self._scorer("array<int>", leaves))
        return at.withColumns({f"__leaf{k}": F.get("__leaves", k) for k in range(len(self.trees))}).drop("__leaves")

    def score(self, df: DataFrame, out: str) -> DataFrame:
        base = self.base

        def total(n, routed):
            value = np.full(n, base)
            for leaf, steps in routed:
                value = value + steps[leaf]
            return pa.array(value)
        return df.withColumn(out, self._scorer("double", total) if self.trees else F.lit(base))

    def staged(self, df: DataFrame, out: str) -> DataFrame:
        """``out``: the prediction after 1, 2, ... rounds as an array, in one scoring pass."""
        base = self.base

        def sums(n, routed):
            value, all_ = np.full(n, base), np.empty((n, len(routed)))
            for k, (leaf, steps) in enumerate(routed):
                value = value + steps[leaf]
                all_[:, k] = value
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(routed)), pa.array(all_.ravel()))
        return df.withColumn(out, self._scorer("array<double>", sums))

    def first(self, rounds: int) -> "AbsoluteBoost":
        return AbsoluteBoost(self.base, self.step, self.trees[:rounds], self.values[:rounds])

    def save(self, path: str, spark: SparkSession) -> None:
        rows = [(k, t.feature, t.cut, t.left, t.depth, v) for k, (t, v) in enumerate(zip(self.trees, self.values))] + [(-1, [], [], [], 0, [self.base, self.step])]
        spark.createDataFrame(rows, "tree int, feature array<int>, cut array<double>, left array<int>, depth int, leaf_values array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "AbsoluteBoost":
        head, *rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])  # a row a tree
        trees = [Tree(list(r["feature"]), list(r["cut"]), list(r["left"]), r["depth"]) for r in rows]
        return cls(*head["leaf_values"], trees, [list(r["leaf_values"]) for r in rows])


@dataclass
class QuantileForest:
    forest: object
    held: list[list[list[float]]]  # tree -> leaf -> quantiles of the leaf's labels

    @classmethod
    def fit(cls, data: DataFrame, label: str, params: dict, seed: int) -> "QuantileForest":
        grower = {k: params[k] for k in (*_TREE, "numTrees") if k in params}
        rows = data.select("__x", F.col(label).alias("__y")).persist()
        forest = RandomForestRegressor(featuresCol="__x", labelCol="__y", predictionCol="__mean", leafCol="__leaf", seed=seed, **grower).fit(rows)
        bound_batches(rows.sparkSession)
        at = forest.transform(rows).select("__y", vector_to_array("__leaf"))
        trees, small = forest.getNumTrees, int(params.get("maxDepth", 5)) < 15

        def labels(batch):
            if batch.num_rows:
                y = batch.column(0).to_numpy(zero_copy_only=False)
                leaf = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, trees).T
                yield [(tree, (numbers.astype(np.int16 if small else np.int32), y)) for tree, numbers in enumerate(leaf)]
        found = exact_ranked(at, labels, [(i + 0.5) / LEAF_QUANTILES for i in range(LEAF_QUANTILES)], LEAF_POINTS)
        # every leaf of a tree has training rows, so a tree's leaves are 0, 1, ... in order
        held = [[found[key] for key in sorted(k for k in found if k[0] == tree)] for tree in range(trees)]
        rows.unpersist()
        return cls(forest, held)

    def score(self, df: DataFrame, out: str) -> DataFrame:
        bound_batches(df.sparkSession)
        first = np.cumsum([0, *map(len, self.held)])[:-1]
        held = np.array([q for leaves in self.held for q in leaves])
        trees = len(self.held)
        n = trees * LEAF_QUANTILES
        low, high = (n - 1) // 2, n // 2

        def middle(leaf: pa.Array) -> pa.Array:
            at = leaf.flatten().to_numpy(zero_copy_only=False).reshape(-1, trees).astype(np.int64) + first
            found = np.empty(len(at))
            for i in range(0, len(at), SCORED_ROWS):
                pooled = np.partition(held[at[i:i + SCORED_ROWS]].reshape(-1, n), (low, high))
                found[i:i + SCORED_ROWS] = (pooled[:, low] + pooled[:, high]) / 2
            return pa.array(found)
        routed = self.forest.transform(df)
        return routed.withColumn(out, F.arrow_udf(middle, "double")(vector_to_array("__leaf"))).drop("__leaf", "__mean")

    def save(self, path: str, spark: SparkSession) -> None:
        self.forest.write().overwrite().save(f"{path}/forest")
        spark.createDataFrame([(tree, leaves) for tree, leaves in enumerate(self.held)], "tree int, leaves array<array<double>>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/leaves")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "QuantileForest":
        from pyspark.ml.regression import RandomForestRegressionModel
        rows = sorted(spark.read.parquet(f"{path}/leaves").collect(), key=lambda r: r["tree"])  # a row a tree
        return cls(RandomForestRegressionModel.load(f"{path}/forest"), [[list(q) for q in r["leaves"]] for r in rows])


@dataclass
class SparkEnsemble:
    """A spark.ml tree ensemble as it is (squared loss)."""

    model: object

    @classmethod
    def fit(cls, data: DataFrame, label: str, params: dict, seed: int) -> "SparkEnsemble":
        from pyspark.ml.regression import GBTRegressor
        keep = {k: params[k] for k in (*_TREE, "maxIter", "stepSize") if k in params}
        return cls(GBTRegressor(featuresCol="__x", labelCol=label, predictionCol="__raw", seed=seed, **keep).fit(data))

    def score(self, df: DataFrame, out: str) -> DataFrame:
        return self.model.transform(df).withColumnRenamed("__raw", out)

    def save(self, path: str, spark: SparkSession) -> None:
        self.model.write().overwrite().save(f"{path}/gbt")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "SparkEnsemble":
        from pyspark.ml.regression import GBTRegressionModel
        return cls(GBTRegressionModel.load(f"{path}/gbt"))


LEARNERS = {"absolute": AbsoluteBoost, "quantile_forest": QuantileForest, "squared": SparkEnsemble}
