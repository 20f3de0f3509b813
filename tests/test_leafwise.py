"""Leaf-wise boosting beside a plain version that splits one leaf at a time."""

import heapq

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from tasador.operators import evaluate, leafwise, models


def plain_boosting(x, y, rounds, rate, leaves, leaf_rows):
    """Predictions of the rows, and rows of the leaves of every tree."""
    f, sizes = np.full(len(y), y.mean()), []
    for _ in range(rounds):
        r = y - f

        def best(at):
            found = None
            for j in range(x.shape[1]):
                values = np.unique(x[at, j])
                for c in (values[:-1] + values[1:]) / 2:
                    left = at[x[at, j] <= c]
                    right = at[x[at, j] > c]
                    if min(len(left), len(right)) < leaf_rows:
                        continue
                    gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[at].sum() ** 2 / len(at)
                    if gain > 1e-9 and (found is None or gain > found[0] * (1 + 1e-9)):
                        found = gain, left, right
            return found

        final, heap, n = [np.arange(len(y))], [], 0
        first = best(final[0])
        if first:
            heap.append((-first[0], n, 0, first))
        while heap and len(final) < leaves:
            _, _, k, (_, left, right) = heapq.heappop(heap)
            final[k] = left
            final.append(right)
            for place in (k, len(final) - 1):
                n += 1
                found = best(final[place])
                if found:
                    heapq.heappush(heap, (-found[0], n, place, found))
        for at in final:
            f[at] += rate * r[at].mean()
        sizes.append(sorted(map(len, final)))
    return f, sizes


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, 500), rng.integers(0, 2, 500), rng.integers(-3, 30, 500) / 4, np.full(500, 2.0)]).astype(float)
    y = 100 + 10 * np.sin(x[:, 0]) + 7 * x[:, 1] * x[:, 2] + rng.normal(0, 2, 500)
    return x, y, spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(3)


@pytest.mark.parametrize("leaves, leaf_rows, task_rows, keep, direct", [(2, 1, 200, 20, 1 << 25), (6, 5, 200, 2, 0), (31, 10, 200, 3, 1 << 25), (31, 10, 65_536, 20, 1 << 25)])
def test_trees_are_those_of_a_queue(data, monkeypatch, leaves, leaf_rows, task_rows, keep, direct):
    """In one task, and over several with the rows checkpointed on the way and the sums added up by tasks or by the driver."""
    for name, value in (("KEEP", keep), ("DIRECT", direct), ("TASK_ROWS", task_rows)):
        monkeypatch.setattr(leafwise, name, value)
    x, y, df = data
    model = models.boosted("label", rounds=5, leaves=leaves, leaf_rows=leaf_rows).fit(df)
    want, sizes = plain_boosting(x, y, 5, 0.1, leaves, leaf_rows)
    got = {(*r.features.toArray().tolist(), r.label): r.prediction for r in model.transform(df).collect()}
    assert [got[(*a.tolist(), b)] for a, b in zip(x, y)] == pytest.approx(want.tolist(), rel=1e-9)
    nodes = model.nodes(df.sparkSession)
    assert [r["count"] for r in nodes.where("feature < 0").groupBy("tree").count().orderBy("tree").collect()] == [len(s) for s in sizes]
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0) and model.featureImportances[3] == 0.0


def test_a_tree_takes_fewer_passes_than_leaves(data, monkeypatch):
    _, _, df = data
    passes = []
    monkeypatch.setattr(leafwise, "TASK_ROWS", 200)
    plain = leafwise._sums_of
    monkeypatch.setattr(leafwise, "_sums_of", lambda *a: passes.append(1) or plain(*a))
    model = models.boosted("label", rounds=1, leaves=31, leaf_rows=5).fit(df)
    assert model.nodes(df.sparkSession).where("feature < 0").count() == 31 and len(passes) <= 12


def test_saved_and_loaded(data, folder):
    _, _, df = data
    model = PipelineModel(stages=[models.boosted("label", rounds=3).fit(df)])
    model.write().overwrite().save(folder)
    pick = lambda m: sorted(r.prediction for r in m.transform(df).collect())
    assert pick(PipelineModel.load(folder)) == pick(model)


def test_nothing_to_split(spark):
    rows = [(Vectors.dense([1.0, 5.0]), 3.0)] * 50 + [(Vectors.dense([1.0, 5.0]), None)]
    df = spark.createDataFrame(rows, ["features", "label"])
    assert {r.prediction for r in models.boosted("label", rounds=4).fit(df).transform(df).collect()} == {3.0}
    with pytest.raises(ValueError, match="label"):
        models.boosted("label").fit(df.where("label IS NULL"))


def test_at_least_as_good_as_level_wise_trees(data):
    _, _, df = data
    train, test = df.randomSplit([0.8, 0.2], 1)
    r2 = lambda m: evaluate.metrics(m.fit(train).transform(test), "label", "prediction").first()["r2"]
    assert r2(models.boosted("label", rounds=30, leaf_rows=5)) > r2(models.gradient_boosting("label", rounds=30)) - 0.01


def test_one_task_adds_up_the_smaller_of_two_children(monkeypatch):
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 64, (4000, 6)).astype(np.uint8), rng.normal(0, 1, 4000)
    summed, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda a, *w: summed.append(len(a)) or plain(a, *w))
    trees = leafwise._trees_of(x, y, 64, 3, 0.1, 31, 20)
    depth = 0
    for feature, cut, left, right, value in trees:
        levels = {0: 0}
        for k in np.flatnonzero(left >= 0).tolist():
            levels |= {int(left[k]): levels[k] + 1, int(right[k]): levels[k] + 1}
        depth += 1 + max(levels.values()) / 2
    assert sum(summed) <= 2 * x.size * depth  # residuals and numbers: all rows once, then at most half of them a level
    assert (y != 0).all()  # the residuals given are left as they are


@pytest.mark.parametrize("direct", [0, 1 << 25])
def test_driver_gets_splits_and_no_sums(spark, monkeypatch, direct):
    monkeypatch.setattr(leafwise, "DIRECT", direct)
    rng = np.random.default_rng(9)
    x, y = rng.integers(0, 64, (900, 4)).astype(np.uint8), rng.normal(0, 1, 900)
    state = spark.sparkContext.parallelize([(x[i::3], y[i::3]) for i in range(3)], 3)
    tree = tuple(np.array(a) for a in ([1, 0, 0], [30, 0, 0], [1, -1, -1], [2, -1, -1], [0.0, 0.0, 0.0]))
    got = leafwise._sums_of(state, 3, tree, np.array([-1, 1, 0]), 4, 64, 20)
    for (total, rows, found), some in zip(got, (x[:, 1] > 30, x[:, 1] <= 30)):
        sums = leafwise._cells(x, y, np.flatnonzero(some), np.arange(4) * 64, 64).reshape(2, 1, 4, 64)
        assert rows == some.sum() and total == pytest.approx(y[some].sum())
        assert found == pytest.approx(leafwise.best_splits(*sums, 20)[0]) and len(found) == 5
