"""A random forest whose nodes are a table: its lower nodes are never held by the driver while it grows, and there is no bound on the depth but the one asked for.

Rows are binned once and lie in packs, and stay where they are. How often a tree has drawn a row follows from the numbers of pack and tree, and the node that a row has come to follows from the splits so far,
which every task gets. A node of many rows is split by a pass over all such nodes of some trees: tasks send sums by node, feature and bin, Spark adds them up and picks a split for each node. A node of at
most ``SMALL`` rows has the rest of its tree grown in one task; only for that, rows are exchanged, once for each tree that has drawn them. A row of the table is a fragment: such a rest as arrays, or one node
that was split by a pass. The driver holds the splits of nodes of many rows, as many as drawn rows over ``SMALL`` a level.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.operators.leafwise import SAME, best_splits, bin_edges
from tasador.session import durable

# tasks of any cluster get the functions of this module with their work
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[best_splits.__module__])

# Trees, depth, least rows of a leaf, seed.
TREES, DEPTH, LEAF_ROWS, SEED = 50, 15, 1, 42
#: Most bins of a feature (at most 256); drawn rows and bytes of bins up to which one task grows the rest of a tree.
BINS, SMALL, SMALL_BYTES = 64, 65_536, 64 << 20
#: Drawn rows that grow side by side; rows that a task holds to put packs of one node together; sums that it holds before it sends them.
WAVE_ROWS, MERGED, HELD = 1 << 28, 1 << 19, 1 << 22
#: Bounds of bins that are broadcast; bytes of fragments that are broadcast at once.
BROADCAST, GROUP_BYTES = 100_000, 128 << 20
#: Nodes of many rows, which a pass splits; of few rows, whose rest one task grows; that are settled.
WIDE, FEW, DONE = 0, 1, 2
#: Depth down to which passes split nodes of many rows: children of k are 2k and 2k + 1, and a number has 64 bits. Nodes of many rows that lie deeper are leaves.
PASSES = 60

_PACK = "tree int, node long, x binary, y binary, w binary"
_FRAGMENT = "tree int, root long, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, gain array<double>"
_SPLIT = "tree int, node long, feature int, bin int, gain double, total double, rows long, left_total double, left_rows long"
_SPLITS = pa.schema([(n, pa.int32()) if t == "int" else (n, pa.int64() if t == "long" else pa.float64()) for n, t in (c.split() for c in _SPLIT.split(", "))])


def _arrays(pack: dict, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(pack["x"], np.uint8).reshape(-1, size), np.frombuffer(pack["y"]), np.frombuffer(pack["w"], np.uint8)


def _packs(parts: list[tuple]) -> pa.RecordBatch:
    """A batch of (tree, node, x, y, w)."""
    tree, node, *data = zip(*parts)
    raw = [pa.array([a.tobytes() for a in d], pa.binary()) for d in data]
    return pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(node, pa.int64()), *raw], names=["tree", "node", "x", "y", "w"])


def drawn(pack: int, tree: int, rows: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row of a pack is drawn for a tree: draws with replacement, seen from one row of many."""
    if not bootstrap:
        return np.ones(rows, np.uint8)
    return np.minimum(np.random.default_rng([seed, tree, pack]).poisson(1.0, rows), 255).astype(np.uint8)


def _by_bin(slot: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows by node, then bin, then place. Numbers of at most 16 bits are sorted digit by digit, in time linear in the rows."""
    if k > 1 << 16:
        return np.argsort(slot * 256 + x, kind="stable")
    order = np.argsort(x, kind="stable")
    return order[np.argsort(slot[order].astype(np.uint16), kind="stable")]


def _level(x: np.ndarray, deviation: np.ndarray, w: np.ndarray, slot: np.ndarray, k: int, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature (-1: none), bin and gain of the best split of each of k nodes; ``deviation``: of each row from the mean of its node."""
    feature, cut, gain = np.full(k, -1), np.zeros(k, np.int64), np.full(k, SAME)
    size = np.bincount(slot, w, k)
    before = np.concatenate([[0.0], np.cumsum(size)])[:-1]
    weighted = w * deviation
    for f in range(x.shape[1]):
        order = _by_bin(slot, x[:, f], k)
        key = (slot * 256 + x[:, f])[order]
        last = np.flatnonzero(key[1:] != key[:-1])  # last row of a bin, and another comes
        of = key[last] // 256
        inner = key[last + 1] // 256 == of
        last, of = last[inner], of[inner]
        n = np.cumsum(w[order])[last] - before[of]
        fine = (n >= leaf_rows) & (size[of] - n >= leaf_rows)
        if not fine.any():
            continue
        last, of, n = last[fine], of[fine], n[fine]
        # deviations of each node add up to nothing, so what is left of a node is not in the sum
        found = np.cumsum(weighted[order])[last] ** 2 * (1 / n + 1 / (size[of] - n))
        first = np.flatnonzero(np.diff(of, prepend=-1))
        top = np.full(k, -np.inf)
        top[of[first]] = np.maximum.reduceat(found, first)
        better = top > gain * (1 + SAME)
        at = np.flatnonzero((found >= top[of] * (1 - SAME)) & better[of])
        node, where = np.unique(of[at], return_index=True)
        feature[node], gain[node] = f, top[node]
        cut[node] = key[last[at[where]]] % 256
    return feature, cut, np.where(feature >= 0, gain, 0.0)


def subtree(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, leaf_rows: int) -> list[np.ndarray]:
    """feature, bin, left, right, value and gain of all nodes of a tree on rows in one place, level by level; left is -1 in leaves."""
    slot, k, start, w = np.zeros(len(x), np.int64), 1, 0, w.astype(float)
    levels = []
    while k:
        mean = np.bincount(slot, w * y, k) / np.bincount(slot, w, k)
        if depth > len(levels):
            feature, cut, gain = _level(x, y - mean[slot], w, slot, k, leaf_rows)
        else:
            feature, cut, gain = np.full(k, -1), np.zeros(k, np.int64), np.zeros(k)
        inner = feature >= 0
        left = np.where(inner, start + k + 2 * (np.cumsum(inner) - 1), -1)
        levels.append((feature, cut, left, np.where(inner, left + 1, -1), mean, gain))
        some = np.flatnonzero(inner[slot])
        x, y, w, slot = x[some], y[some], w[some], slot[some]
        right = x[np.arange(len(x)), feature[slot]] > cut[slot]
        start, slot, k = start + k, 2 * (np.cumsum(inner) - 1)[slot] + right, 2 * int(inner.sum())
    return [np.concatenate(a) for a in zip(*levels)]


def _at(x: np.ndarray, tree: dict) -> np.ndarray:
    """The place of each row among the nodes of a tree that is split so far."""
    at, every = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(every):
        every = every[tree["left"][at[every]] >= 0]
        k = at[every]
        at[every] = tree["left"][k] + (x[every, tree["feature"][k]] > tree["bin"][k])
    return at


def _drawn_rows(batches, held, kind: int, size: int, seed: int, bootstrap: bool):
    """tree, nodes, slots, x, y, w: of each pack and tree the drawn rows at nodes of a kind, with the place of their node among ``nodes``."""
    for batch in batches:
        for r in batch.to_pylist():
            x, y = np.frombuffer(r["x"], np.uint8).reshape(-1, size), np.frombuffer(r["y"])
            for number, tree in held.value.items():
                if not (tree["kind"] == kind).any():
                    continue
                w = drawn(r["pack"], number, len(y), seed, bootstrap)
                some = np.flatnonzero(w)
                at = _at(x[some], tree)
                wanted = tree["kind"][at] == kind
                some, at = some[wanted], at[wanted]
                if len(some):
                    places, slots = np.unique(at, return_inverse=True)
                    yield number, tree["node"][places], slots, x[some], y[some], w[some]


def _sums(held, size: int, bins: int, seed: int, bootstrap: bool):
    """tree, node, cell, total, rows: what a task has of each node of many rows, by feature and bin."""

    def sent(sums: dict) -> pa.RecordBatch:
        cells = [np.flatnonzero(rows) for _, rows in sums.values()]
        key = np.repeat(np.array(list(sums), np.int64).reshape(-1, 2), [len(c) for c in cells], 0)
        values = [pa.array(np.concatenate([v[k][c] for v, c in zip(sums.values(), cells)])) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(key[:, 0], pa.int32()), pa.array(key[:, 1]), pa.array(np.concatenate(cells), pa.int32()), *values], names=["tree", "node", "cell", "total", "rows"])

    def run(batches):
        sums, cells = {}, size * bins
        for tree, nodes, slots, x, y, w in _drawn_rows(batches, held, WIDE, size, seed, bootstrap):
            cell = (slots[:, None] * cells + np.arange(size) * bins + x).ravel()
            found = [np.bincount(cell, np.repeat(v, size), len(nodes) * cells).reshape(-1, cells) for v in (w * y, w)]
            for i, node in enumerate(nodes.tolist()):
                own = sums.setdefault((tree, node), np.zeros((2, cells)))
                own += found[0][i], found[1][i]
            if len(sums) * cells > HELD:
                yield sent(sums)
                sums = {}
        if sums:
            yield sent(sums)

    return run


def _best(size: int, bins: int, leaf_rows: int):
    def run(group: pa.Table) -> pa.Table:
        total, rows = np.zeros((2, 1, size * bins))
        cell = group.column("cell").to_numpy()
        total[0, cell], rows[0, cell] = group.column("total").to_numpy(), group.column("rows").to_numpy()
        total, rows = total.reshape(1, size, bins), rows.reshape(1, size, bins)
        found = best_splits(total, rows, leaf_rows)[0]
        gain, f, b, left_total, left_rows = found or (0.0, -1, 0, 0.0, 0)
        row = {"tree": group["tree"][0].as_py(), "node": group["node"][0].as_py(), "feature": f, "bin": b, "gain": gain}
        row |= {"total": float(total[0, 0].sum()), "rows": int(rows[0, 0].sum()), "left_total": left_total, "left_rows": left_rows}
        return pa.Table.from_pylist([row], _SPLITS)

    return run


def _packs_of(held, size: int, seed: int, bootstrap: bool):
    """Packs of the nodes of few rows; those of one node are put together as far as a task holds them."""

    def sent(parts: dict) -> pa.RecordBatch:
        return _packs([(*k, *(np.concatenate(a) for a in zip(*p))) for k, p in parts.items()])

    def run(batches):
        parts, rows = {}, 0
        for tree, nodes, slots, x, y, w in _drawn_rows(batches, held, FEW, size, seed, bootstrap):
            order = np.argsort(slots, kind="stable")
            bounds = np.searchsorted(slots[order], np.arange(len(nodes) + 1))
            for node, a, b in zip(nodes.tolist(), bounds[:-1], bounds[1:]):
                parts.setdefault((tree, node), []).append((x[order[a:b]], y[order[a:b]], w[order[a:b]]))
            rows += len(y)
            if rows > MERGED:
                yield sent(parts)
                parts, rows = {}, 0
        if parts:
            yield sent(parts)

    return run


def _rest(edges: list[np.ndarray], mean: float, depth: int, leaf_rows: int):
    """The fragment of a node of few rows."""

    def run(group: pa.Table) -> pa.Table:
        packs = group.sort_by([("y", "ascending"), ("x", "ascending")]).to_pylist()  # an order of their own, so that sums are the same in every run
        x, y, w = (np.concatenate(a) for a in zip(*(_arrays(p, len(edges)) for p in packs)))
        node = packs[0]["node"]
        feature, cut, left, right, value, gain = subtree(x, y, w, depth - (node.bit_length() - 1), leaf_rows)
        threshold = [float(edges[f][b]) if f >= 0 else 0.0 for f, b in zip(feature.tolist(), cut.tolist())]
        kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        lists = [pa.array([a], pa.list_(t)) for a, t in zip((feature, threshold, left, right, value + mean, gain), kinds)]
        names = ["tree", "root", "feature", "threshold", "left", "right", "value", "gain"]
        return pa.Table.from_arrays([pa.array([packs[0]["tree"]], pa.int32()), pa.array([node], pa.int64()), *lists], names=names)

    return run


def _node_fragments(splits: DataFrame, edges: list[np.ndarray], mean: float) -> DataFrame:
    """Nodes split by a pass as fragments of one node; a child -2 is another fragment."""
    rows = [(f, b, float(v)) for f, e in enumerate(edges) for b, v in enumerate(e)]
    bounds = splits.sparkSession.createDataFrame(rows, "feature int, bin int, threshold double")
    one = lambda c: F.array(c).alias
    child = F.when(F.col("feature") >= 0, -2).otherwise(-1)
    found = splits.join(F.broadcast(bounds) if len(rows) <= BROADCAST else bounds, ["feature", "bin"], "left")
    return found.select(
        "tree", F.col("node").alias("root"), one("feature")("feature"), one(F.coalesce("threshold", F.lit(0.0)))("threshold"), one(child)("left"), one(child)("right"),
        one(F.col("total") / F.col("rows") + mean)("value"), one("gain")("gain"),
    )


class _Grown:
    """The nodes of a tree that passes have made, as far as rows have to find them; children lie side by side."""

    def __init__(self, kind: int):
        self.node, self.kind, self.feature, self.bin, self.left, self.place = [1], [kind], [-1], [0], [-1], {1: 0}

    def arrays(self) -> dict[str, np.ndarray]:
        return {c: np.array(getattr(self, c), np.int64) for c in ("node", "kind", "feature", "bin", "left")}

    def split(self, r, small: int, last: bool) -> list[tuple]:
        """Take the split of a node of many rows. After the last pass, children of many rows are leaves, which are returned."""
        k, leaves = self.place[r.node], []
        self.kind[k] = DONE
        if r.feature < 0:
            return leaves
        self.feature[k], self.bin[k], self.left[k] = r.feature, r.bin, len(self.node)
        for side, rows, total in ((0, r.left_rows, r.left_total), (1, r.rows - r.left_rows, r.total - r.left_total)):
            node = 2 * r.node + side
            kind = FEW if rows <= small else DONE if last else WIDE
            if kind == DONE:
                leaves.append((r.tree, node, -1, 0, 0.0, total, rows, 0.0, 0))
            self.place[node] = len(self.node)
            for column, value in zip((self.node, self.kind, self.feature, self.bin, self.left), (node, kind, -1, 0, -1)):
                column.append(value)
        return leaves


class NodeForest(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of trees on rows drawn with replacement, all features at every node; rows without a label are left out.

    ``depth`` 0 is no bound; ``leafRows`` counts drawn rows. Without ``bootstrap`` every tree has each row once.
    """

    trees = Param(Params._dummy(), "trees", "trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "most splits from the root to a leaf, 0: no bound", TypeConverters.toInt)
    leafRows = Param(Params._dummy(), "leafRows", "least rows of a leaf", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "most bins of a feature, 256 at most", TypeConverters.toInt)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether rows are drawn", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, trees=None, depth=None, leafRows=None, bins=None, bootstrap=None, seed=None, featuresCol=None, labelCol=None, predictionCol=None):
        super().__init__()
        self._setDefault(trees=TREES, depth=DEPTH, leafRows=LEAF_ROWS, bins=BINS, bootstrap=True, seed=SEED)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NodeForestModel":
        trees, depth, leaf_rows, bins, bootstrap, seed = (self.getOrDefault(p) for p in (self.trees, self.depth, self.leafRows, self.bins, self.bootstrap, self.seed))
        depth = depth or sys.maxsize
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
                    yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary()), pa.array([(batch.column("y").to_numpy() - mean).tobytes()], pa.binary())], names=["x", "y"])

        # packs get their numbers with the files, so that a task that runs again draws the same rows
        binned = durable(rows.mapInArrow(to_bins, "x binary, y binary").withColumn("pack", F.monotonically_increasing_id()), "packs")
        small, wave, parts = min(SMALL, max(1, SMALL_BYTES // size)), max(1, min(trees, WAVE_ROWS // n)), []
        context = dataset.sparkSession.sparkContext
        for first in range(0, trees, wave):
            # roots have about as many drawn rows as there are rows
            grown = {t: _Grown(WIDE if n + 10 * n**0.5 > small else FEW) for t in range(first, min(first + wave, trees))}
            for level in range(min(depth, PASSES)):
                if not any(WIDE in g.kind for g in grown.values()):
                    break
                held = context.broadcast({t: g.arrays() for t, g in grown.items()})
                sums = binned.mapInArrow(_sums(held, size, bins, seed, bootstrap), "tree int, node long, cell int, total double, rows double")
                sums = sums.groupBy("tree", "node", "cell").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
                splits = durable(sums.groupBy("tree", "node").applyInArrow(_best(size, bins, leaf_rows), _SPLIT), "splits")
                held.unpersist()
                parts.append(_node_fragments(splits, edges, float(mean)))
                leaves = []
                for r in splits.collect():  # a row for each node of many rows: there are no more than drawn rows / SMALL
                    leaves += grown[r.tree].split(r, small, level + 1 == min(depth, PASSES))
                if leaves:
                    parts.append(_node_fragments(dataset.sparkSession.createDataFrame(leaves, _SPLIT), edges, float(mean)))
            if any(FEW in g.kind for g in grown.values()):
                held = context.broadcast({t: g.arrays() for t, g in grown.items()})
                packs = binned.mapInArrow(_packs_of(held, size, seed, bootstrap), _PACK)
                parts.append(packs.groupBy("tree", "node").applyInArrow(_rest(edges, float(mean), depth, leaf_rows), _FRAGMENT))
        fragments = parts[0]
        for p in parts[1:]:
            fragments = fragments.unionByName(p)
        model = NodeForestModel(trees=trees, size=size)
        model.fragments = durable(fragments, "forest")
        return self._copyValues(model)


def _group_trees(rows: list) -> list[tuple]:
    """root, feature, threshold, left, right, value of each tree of some fragments; children in fragments that are not there, and none, are leaves of value 0 at the end."""
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["tree"], []).append(r)
    out = []
    for tree in sorted(by_tree):
        own, first, at = by_tree[tree], {}, 0
        for r in own:
            first[r["root"]] = at
            at += len(r["feature"])
        feature, threshold, value = (np.concatenate([np.asarray(r[c]) for r in own] + [[x]]) for c, x in (("feature", -1), ("threshold", 0.0), ("value", 0.0)))
        sides = []
        for side, c in enumerate(("left", "right")):
            linked = []
            for r in own:
                k = np.asarray(r[c], np.int64)
                linked.append(np.where(k >= 0, k + first[r["root"]], -1) if k[0] != -2 else np.array([first.get(2 * r["root"] + side, at)]))
            sides.append(np.concatenate([*linked, [-1]]))
        out.append((first.get(1, at), feature.astype(np.int32), threshold, *(s.astype(np.int32) for s in sides), value))
    return out


def _predictor(held, size: int):
    """Sum over the trees of a broadcast group."""

    def predict(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        out = np.zeros(len(rows))
        for root, feature, threshold, left, right, value in held.value:
            at, every = np.full(len(rows), root), np.arange(len(rows))
            while len(every):
                every = every[left[at[every]] >= 0]
                k = at[every]
                at[every] = np.where(rows[every, feature[k]] <= threshold[k], left[k], right[k])
            out += value[at]
        return pa.array(out)

    return predict


class _Writer(MLWriter):
    def __init__(self, model: "NodeForestModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.fragments.write.parquet(f"{path.rstrip('/')}/fragments")


class _Reader(MLReader):
    def load(self, path: str) -> "NodeForestModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NodeForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.fragments = self.sparkSession.read.schema(_FRAGMENT).parquet(f"{path.rstrip('/')}/fragments")
        return model


class NodeForestModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, MLReadable, MLWritable):
    """``fragments``: the table of nodes. Where it has more than ``GROUP_BYTES``, predictions add up groups of fragments, each broadcast by itself."""

    size = Param(Params._dummy(), "size", "features", TypeConverters.toInt)
    trees, depth, leafRows, bins, bootstrap, seed = (getattr(NodeForest, p) for p in ("trees", "depth", "leafRows", "bins", "bootstrap", "seed"))
    fragments: DataFrame

    @keyword_only
    def __init__(self, *, trees=None, size=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    @property
    def featureImportances(self) -> DenseVector:
        """Part of a tree's gains that each feature has, on average over the trees that have any."""
        gains = self.fragments.select("tree", F.explode(F.arrays_zip("feature", "gain")).alias("n")).where("n.feature >= 0")
        gains = gains.groupBy("tree", "n.feature").agg(F.sum("n.gain").alias("gain")).collect()  # trees x features numbers
        out, totals = np.zeros(self.getOrDefault("size")), {}
        for r in gains:
            totals[r.tree] = totals.get(r.tree, 0.0) + r.gain
        for r in gains:
            out[r.feature] += r.gain / totals[r.tree]
        return DenseVector(out / max(len(totals), 1))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """tree, root, place, feature, threshold, value and gain of every node."""
        return self.fragments.select("tree", "root", F.posexplode(F.arrays_zip("feature", "threshold", "value", "gain")).alias("place", "n")).select("tree", "root", "place", "n.*")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, size, trees = dataset.sparkSession, self.getOrDefault("size"), self.getOrDefault("trees")
        number = self.fragments.agg(F.sum(F.size("feature"))).first()[0]
        groups = max(1, -(-number * 28 // GROUP_BYTES))
        shared = F.col("left")[0] == -2
        total = F.lit(0.0)
        for g in range(groups):
            mine = self.fragments.where(shared | (F.pmod(F.xxhash64("tree", "root"), F.lit(groups)) == g)) if groups > 1 else self.fragments
            rows = mine.select("tree", "root", "feature", "threshold", "left", "right", "value").toArrow()
            lists = [[{"tree": b.column(0)[i].as_py(), "root": b.column(1)[i].as_py()} | {c: b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("feature", "threshold", "left", "right", "value")} for i in range(b.num_rows)] for b in rows.to_batches()]
            held = spark.sparkContext.broadcast(_group_trees([r for part in lists for r in part]))

            total = total + F.arrow_udf(_predictor(held, size), "double")(vector_to_array(F.col(self.getFeaturesCol())))
        return dataset.withColumn(self.getPredictionCol(), total / trees)
