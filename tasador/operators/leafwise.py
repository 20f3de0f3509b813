"""Leaf-wise gradient boosting of squared errors: the open leaf with the largest gain is split next, wherever it lies in the tree.

Rows are binned once; a row is then one byte for each feature, and the rows of a task lie in a few arrays (an RDD of arrays, as a pass is numpy on whole partitions and there are thousands of
passes). A pass over the rows adds up residuals by open leaf, feature and bin: each task sends its sums, whose size does not depend on
its rows, to tasks that pick the split of each leaf. Splitting one leaf at a time would take a pass for each split; here a pass serves all leaves that the queue would split if nothing better came up, so that a tree takes about as many
passes as it is deep. Nodes that turn out not to be among the best are dropped, and the tree is the one that a queue alone gives.
"""

from __future__ import annotations

import heapq
import sys
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.session import durable, shared_folder

# tasks of any cluster get the functions of this module with their work
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rounds, learning rate, leaves of a tree, least rows of a leaf.
ROUNDS, RATE, LEAVES, LEAF_ROWS = 200, 0.1, 31, 20
#: Bins of a feature (at most 256), accuracy of the quantiles that bound them.
BINS, ACCURACY = 64, 10_000
#: Rows that one task should have at least; rounds after which the rows are checkpointed; bytes of sums of a pass that are sent straight to the driver, and that one task adds up.
TASK_ROWS, KEEP, DIRECT, ADDED = 65_536, 20, 64 << 10, 4 << 20
#: Gains whose parts differ by less are equal, and the smaller feature and bin decide.
SAME = 1e-9


@dataclass
class Node:
    """A node of a growing tree; ``feature`` and ``bin`` of its best split, None if it has none."""

    total: float
    rows: int
    gain: float | None = None
    feature: int = -1
    bin: int = -1
    left_total: float = 0.0
    left_rows: int = 0
    parent: int = -1
    children: tuple[int, int] | None = None


def bin_edges(rows: DataFrame, size: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature but the last: midpoints of neighbouring values where there are few values, else quantiles. Two passes."""
    x, cuts = F.col("x"), [k / bins for k in range(1, bins)]
    found = rows.agg(*[a for i in range(size) for a in (F.percentile_approx(x[i], cuts, ACCURACY), F.approx_count_distinct(x[i]))]).first()
    few = [i for i in range(size) if found[2 * i + 1] <= 2 * bins]
    sets = rows.agg(*[F.collect_set(x[i]) for i in few]).first() if few else []
    values = {i: np.unique(np.array(v, float)) for i, v in zip(few, sets)}
    edges = []
    for i in range(size):
        if i in values and len(values[i]) <= bins:
            edges.append((values[i][:-1] + values[i][1:]) / 2)
        else:
            edges.append(np.unique(np.array(found[2 * i] or [], float)))
    return edges


def best_splits(sums: np.ndarray, rows: np.ndarray, leaf_rows: int) -> list[tuple[float, int, int, float, int] | None]:
    """For each leaf gain, feature, bin, residuals and rows on the left of its best split. ``sums`` and ``rows``: by leaf, feature, bin."""
    left, n = np.cumsum(sums, 2)[:, :, :-1], np.cumsum(rows, 2)[:, :, :-1]
    total, size = sums[:, :1].sum(2)[:, :, None], rows[:, :1].sum(2)[:, :, None]
    fine = (n >= leaf_rows) & (size - n >= leaf_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fine, left**2 / n + (total - left) ** 2 / (size - n) - total**2 / size, -np.inf)
    out: list = []
    for i, flat in enumerate(gain.reshape(len(gain), -1)):
        top = flat.max(initial=-np.inf)
        if not np.isfinite(top) or top <= SAME:
            out.append(None)
            continue
        k = int(np.flatnonzero(flat >= top * (1 - SAME))[0])
        f, b = divmod(k, gain.shape[2])
        out.append((float(flat[k]), f, b, float(left[i, f, b]), int(n[i, f, b])))
    return out


def queue(nodes: list[Node], leaves: int) -> tuple[list[int], list[int]]:
    """Nodes that a best-first queue splits, in order, as far as gains are known; and those of them whose children are not known yet."""
    heap, split, unknown = [(-(nodes[0].gain or 0.0), 0)] if nodes[0].gain is not None else [], [], []
    while heap and len(split) < leaves - 1:
        _, k = heapq.heappop(heap)
        split.append(k)
        if nodes[k].children is None:
            unknown.append(k)
            continue
        for c in nodes[k].children:
            if nodes[c].gain is not None:
                heapq.heappush(heap, (-nodes[c].gain, c))
    return split, unknown


def _leaf_of(tree: tuple, x: np.ndarray) -> np.ndarray:
    """The leaf of each binned row."""
    feature, cut, left, right = tree[:4]
    at, every = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(every):
        every = every[left[at[every]] >= 0]
        k = at[every]
        at[every] = np.where(x[every, feature[k]] <= cut[k], left[k], right[k])
    return at


def _sums_of(state: RDD, tasks: int, tree: tuple, slots: np.ndarray, size: int, bins: int, leaf_rows: int) -> list[tuple]:
    """Residuals, rows and best split of each open leaf. ``slots``: number of a node of the growing tree among the open leaves, or -1.

    Tasks send sums by leaf, and other tasks add up those of a leaf, in the order of their tasks, and pick its split: the driver gets splits only.
    """
    number, cells = int(slots.max()) + 1, size * bins

    def run(task: int, parts):
        total, rows = np.zeros(number * cells), np.zeros(number * cells)
        for x, residual in parts:
            slot = slots[_leaf_of(tree, x)]
            some = np.flatnonzero(slot >= 0)
            key = ((slot[some, None] * size + np.arange(size)) * bins + x[some]).ravel()
            total += np.bincount(key, np.repeat(residual[some], size), number * cells)
            rows += np.bincount(key, minlength=number * cells)
        for leaf, sums in enumerate(np.stack([total.reshape(number, cells), rows.reshape(number, cells)], 1)):
            yield (leaf, task), sums

    def best(parts):
        for leaf, group in groupby(parts, key=lambda p: p[0][0]):
            total, rows = reduce(np.add, (sums for _, sums in group)).reshape(2, 1, size, bins)
            yield leaf, float(total[0, 0].sum()), int(rows[0, 0].sum()), best_splits(total, rows, leaf_rows)[0]

    found = state.mapPartitionsWithIndex(run)
    if tasks * number * cells * 16 <= DIRECT:
        picked = list(best(sorted(found.collect(), key=lambda p: p[0])))
    else:
        parts = min(number, tasks, -(-tasks * number * cells * 16 // ADDED))
        picked = found.repartitionAndSortWithinPartitions(parts, lambda key: key[0]).mapPartitions(best).collect()  # a row for each open leaf
    return [p[1:] for p in sorted(picked, key=lambda p: p[0])]


def _advanced(state: RDD, tree: tuple) -> RDD:
    """The rows with a tree taken off their residuals."""
    return state.map(lambda part: (part[0], part[1] - tree[4][_leaf_of(tree, part[0])]))


def _cells(x: np.ndarray, residual: np.ndarray, some: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """Residuals and numbers of some rows by feature and bin."""
    key, size = (x[some] + offsets).ravel(), len(offsets)
    return np.stack([np.bincount(key, w, size * bins) for w in (np.repeat(residual[some], size), None)])


def _trees_of(x: np.ndarray, residual: np.ndarray, bins: int, rounds: int, rate: float, leaves: int, leaf_rows: int) -> list[tuple]:
    """All trees of rows that lie in one place. Of two children the one of fewer rows is added up, and the other is what that leaves of their parent."""
    trees, size, residual = [], x.shape[1], residual.copy()
    offsets = np.arange(size) * bins
    while len(trees) < rounds:
        rows_of, cells = {0: np.arange(len(x))}, {}

        def divide(node: Node, k: int) -> None:
            mine = rows_of.pop(k)
            goes = x[mine, node.feature] <= node.bin
            for child, side in zip(node.children, (goes, ~goes)):
                rows_of[child] = mine[side]

        def sums_of(nodes: list[Node], open_: list[int]):
            if open_ == [0]:
                cells[0] = _cells(x, residual, rows_of[0], offsets, bins)
            for k in dict.fromkeys(nodes[k].parent for k in open_ if k):
                divide(nodes[k], k)
                few, many = sorted(nodes[k].children, key=lambda c: len(rows_of[c]))
                cells[few] = _cells(x, residual, rows_of[few], offsets, bins)
                cells[many] = cells.pop(k) - cells[few]
            total, rows = np.stack([cells[k] for k in open_], 1).reshape(2, len(open_), size, bins)
            return list(zip(total[:, 0].sum(1).tolist(), rows[:, 0].sum(1).astype(int).tolist(), best_splits(total, rows, leaf_rows)))

        nodes, split = grow(sums_of, leaves, leaf_rows)
        inner = set(split)
        trees.append(_arrays(nodes, inner, rate))
        for k in [k for k in rows_of if k in inner]:  # whose children were too small to be looked at
            divide(nodes[k], k)
        leaf = [0] * len(nodes)  # the leaf that each node lies in
        for k in range(1, len(nodes)):
            leaf[k] = k if nodes[k].parent in inner else leaf[nodes[k].parent]
        for k, mine in rows_of.items():
            residual[mine] -= trees[-1][4][leaf[k]]
        if not split:
            break
    return trees


def _arrays(nodes: list[Node], split: set[int], rate: float) -> tuple:
    """feature, bin, left, right and value of each node; left is -1 in leaves."""
    inner = [k in split and n.children is not None for k, n in enumerate(nodes)]
    pick = lambda f, other: np.array([f(n) if i else other for n, i in zip(nodes, inner)], np.int64)
    value = np.array([rate * n.total / n.rows if n.rows else 0.0 for n in nodes])
    return pick(lambda n: n.feature, 0), pick(lambda n: n.bin, 0), pick(lambda n: n.children[0], -1), pick(lambda n: n.children[1], -1), value


def grow(sums_of, leaves: int, leaf_rows: int) -> tuple[list[Node], list[int]]:
    """Nodes of a best-first tree and those that are split, in order. ``sums_of(nodes, open)``: residuals, rows and best split of each open leaf."""

    def keep(k: int, found: tuple | None) -> None:
        if found is not None:
            nodes[k].gain, nodes[k].feature, nodes[k].bin, nodes[k].left_total, nodes[k].left_rows = found

    def look(open_: list[int]) -> None:
        wide = [k for k in open_ if nodes[k].rows >= 2 * leaf_rows]
        if not wide:
            return
        for k, (_, _, found) in zip(wide, sums_of(nodes, wide)):
            keep(k, found)

    nodes = [Node(0.0, 1 << 62)]
    total, rows, found = sums_of(nodes, [0])[0]
    nodes[0] = Node(total, rows)
    keep(0, found)
    while True:
        split, unknown = queue(nodes, leaves)
        if not unknown:
            return nodes, split
        born = []
        for k in unknown:
            n = nodes[k]
            n.children = len(nodes), len(nodes) + 1
            nodes += [Node(n.left_total, n.left_rows, parent=k), Node(n.total - n.left_total, n.rows - n.left_rows, parent=k)]
            born += n.children
        look(born)


class LeafwiseBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Trees of at most ``leaves`` leaves, each on the residuals of those before it; rows without a label are left out."""

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "part of a leaf's mean residual that is added", TypeConverters.toFloat)
    leaves = Param(Params._dummy(), "leaves", "most leaves of a tree", TypeConverters.toInt)
    leafRows = Param(Params._dummy(), "leafRows", "least rows of a leaf", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "most bins of a feature, 256 at most", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rounds=None, rate=None, leaves=None, leafRows=None, bins=None, featuresCol=None, labelCol=None, predictionCol=None):
        super().__init__()
        self._setDefault(rounds=ROUNDS, rate=RATE, leaves=LEAVES, leafRows=LEAF_ROWS, bins=BINS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LeafwiseModel":
        rounds, rate, leaves, leaf_rows, bins = (self.getOrDefault(p) for p in (self.rounds, self.rate, self.leaves, self.leafRows, self.bins))
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")).where("y IS NOT NULL")
        n, mean, size = rows.agg(F.count("y"), F.avg("y"), F.max(F.size("x"))).first()
        if not n:
            raise ValueError("no rows with a label")
        edges = bin_edges(rows, size, bins)

        def to_bins(batches):
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                    packed = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], 1).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary()), pa.array([(batch.column("y").to_numpy() - mean).tobytes()], pa.binary())], names=["bins", "residual"])

        tasks = max(1, -(-n // TASK_ROWS))
        binned = durable(rows.repartition(tasks).mapInArrow(to_bins, "bins binary, residual binary"), "binned")
        if tasks == 1:  # one task would serve every pass: it grows all trees, without a job for each pass
            def whole(rows):
                parts = [(np.frombuffer(r.bins, np.uint8).reshape(-1, size), np.frombuffer(r.residual)) for r in rows]
                yield _trees_of(*(np.concatenate(p) for p in zip(*parts)), bins, rounds, rate, leaves, leaf_rows)

            return self._copyValues(_model(binned.coalesce(1).rdd.mapPartitions(whole).first(), edges, size, float(mean)))
        state = binned.rdd.map(lambda r: (np.frombuffer(r.bins, np.uint8).reshape(-1, size), np.frombuffer(r.residual))).persist(StorageLevel.MEMORY_AND_DISK)
        shared_folder(dataset.sparkSession)  # checkpoints go there
        trees, held = [], [state]
        try:
            while len(trees) < rounds:

                def sums_of(nodes: list[Node], open_: list[int]):
                    slots = np.full(len(nodes), -1)
                    slots[open_] = np.arange(len(open_))
                    return _sums_of(state, tasks, _arrays(nodes, set(range(len(nodes))), rate), slots, size, bins, leaf_rows)

                nodes, split = grow(sums_of, leaves, leaf_rows)
                trees.append(_arrays(nodes, set(split), rate))
                while len(held) > 1:
                    held.pop(0).unpersist()  # the rows of the round before
                if not split:
                    break
                state = _advanced(state, trees[-1]).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(state)
                if len(trees) % KEEP == 0:
                    state.checkpoint()
        finally:
            for rdd in held:
                rdd.unpersist()
        return self._copyValues(_model(trees, edges, size, float(mean)))


def _model(trees: list, edges: list[np.ndarray], size: int, mean: float) -> "LeafwiseModel":
    feature, threshold, left, right, value, roots, at = [], [], [], [], [], [], 0
    for f, b, lo, hi, v in trees:
        kept, order = {0: 0}, [0]  # nodes that the tree reaches
        for k in order:
            if lo[k] >= 0:
                for c in (int(lo[k]), int(hi[k])):
                    kept[c] = len(order)
                    order.append(c)
        roots.append(at)
        for k in order:
            inner = lo[k] >= 0
            feature.append(int(f[k]) if inner else -1)
            threshold.append(float(edges[f[k]][b[k]]) if inner else 0.0)
            left.append(at + kept[int(lo[k])] if inner else -1)
            right.append(at + kept[int(hi[k])] if inner else -1)
            value.append(float(v[k]))
        at += len(order)
    return LeafwiseModel(roots=roots, feature=feature, threshold=threshold, left=left, right=right, value=value, start=mean, size=size)


class LeafwiseModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """All trees as rows: a node has a feature and a threshold (up to it: left) or is a leaf (feature -1) with a value."""

    roots = Param(Params._dummy(), "roots", "first node of each tree", TypeConverters.toListInt)
    feature = Param(Params._dummy(), "feature", "feature of each node, -1 in leaves", TypeConverters.toListInt)
    threshold = Param(Params._dummy(), "threshold", "largest value that goes left", TypeConverters.toListFloat)
    left = Param(Params._dummy(), "left", "left child", TypeConverters.toListInt)
    right = Param(Params._dummy(), "right", "right child", TypeConverters.toListInt)
    value = Param(Params._dummy(), "value", "what a leaf adds", TypeConverters.toListFloat)
    start = Param(Params._dummy(), "start", "prediction before the first tree", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "features", TypeConverters.toInt)
    rounds, rate, leaves, leafRows, bins = (getattr(LeafwiseBoosting, n) for n in ("rounds", "rate", "leaves", "leafRows", "bins"))

    @keyword_only
    def __init__(self, *, roots=None, feature=None, threshold=None, left=None, right=None, value=None, start=None, size=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def featureImportances(self) -> DenseVector:
        """Part of all splits that each feature has."""
        feature = np.array(self.getOrDefault("feature"))
        counts = np.bincount(feature[feature >= 0], minlength=self.getOrDefault("size")).astype(float)
        return DenseVector(counts / max(counts.sum(), 1.0))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, threshold, left, right and value of every node."""
        roots = self.getOrDefault("roots")
        columns = [self.getOrDefault(c) for c in ("feature", "threshold", "left", "right", "value")]
        tree = np.searchsorted(roots, np.arange(len(columns[0])), "right") - 1
        return spark.createDataFrame([(int(t), k, *r) for k, (t, r) in enumerate(zip(tree, zip(*columns)))], "tree int, node int, feature int, threshold double, left int, right int, value double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        roots, feature, left, right = (np.array(self.getOrDefault(c), np.int64) for c in ("roots", "feature", "left", "right"))
        threshold, value = (np.array(self.getOrDefault(c), float) for c in ("threshold", "value"))
        start, size = self.getOrDefault("start"), self.getOrDefault("size")

        def predict(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            out = np.full(len(rows), start)
            for root in roots:
                at, every = np.full(len(rows), root), np.arange(len(rows))
                while len(every):
                    every = every[left[at[every]] >= 0]
                    k = at[every]
                    at[every] = np.where(rows[every, feature[k]] <= threshold[k], left[k], right[k])
                out += value[at]
            return pa.array(out)

        return dataset.withColumn(self.getPredictionCol(), F.arrow_udf(predict, "double")(vector_to_array(F.col(self.getFeaturesCol()))))
