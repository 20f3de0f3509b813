"""The forest of node tables beside a plain version, in one task and by passes."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from tasador.operators import forest, models


def plain_tree(x, y, depth, leaf_rows):
    """Prediction of each row, splitting one node at a time."""
    out = np.zeros(len(y))

    def split(at, level):
        best = None
        r = y[at] - y[at].mean()
        if level < depth:
            for j in range(x.shape[1]):
                for c in np.unique(x[at, j])[:-1]:
                    left = x[at, j] <= c
                    n = left.sum()
                    if min(n, len(at) - n) < leaf_rows:
                        continue
                    gain = r[left].sum() ** 2 / n + r[~left].sum() ** 2 / (len(at) - n)
                    if gain > (best[0] * (1 + 1e-9) if best else 1e-9):
                        best = gain, left
        if best is None:
            out[at] = y[at].mean()
        else:
            split(at[best[1]], level + 1)
            split(at[~best[1]], level + 1)

    split(np.arange(len(y)), 0)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 12, 600), rng.integers(0, 2, 600), rng.integers(-3, 30, 600) / 4, np.full(600, 2.0)]).astype(float)
    y = 100 + 10 * np.sin(x[:, 0]) + 7 * x[:, 1] * x[:, 2] + rng.normal(0, 2, 600)
    df = spark.createDataFrame([(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], ["id", "features", "label"])
    return x, y, df.repartition(3)


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize(
    "small, broadcast, group, depth, leaf_rows",
    [(65_536, 100_000, 1 << 27, 3, 10), (65_536, 100_000, 1 << 27, 0, 1), (60, 100_000, 1 << 27, 1, 1), (60, 0, 8000, 0, 7), (1, 100_000, 1 << 27, 3, 10)],
)
def test_one_tree_equals_a_plain_one(data, monkeypatch, small, broadcast, group, depth, leaf_rows):
    """``small`` 60: the upper nodes are split by passes; 1: nearly all are."""
    x, y, df = data
    for name, value in (("SMALL", small), ("BROADCAST", broadcast), ("GROUP_BYTES", group)):
        monkeypatch.setattr(forest, name, value)
    model = models.random_forest("label", 1, depth, leaf_rows=leaf_rows, bootstrap=False).fit(df)
    assert predictions(model, df) == pytest.approx(plain_tree(x, y, depth or 10**6, leaf_rows))
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_passes_and_one_task_grow_the_same_forest(data, monkeypatch, folder):
    """Also in waves of trees, and after saving."""
    _, y, df = data
    whole = predictions(models.random_forest("label", 6, 0, leaf_rows=3).fit(df), df)
    for name, value in (("SMALL", 200), ("WAVE_ROWS", 1300), ("MERGED", 50), ("HELD", 500)):
        monkeypatch.setattr(forest, name, value)
    model = models.random_forest("label", 4, 0, leaf_rows=3).fit(df)
    assert model.nodes(df.sparkSession).select("tree").distinct().count() == 4
    got = predictions(model, df)
    assert np.corrcoef(got, y)[0, 1] > 0.95 and np.corrcoef(whole, y)[0, 1] > 0.95
    assert np.mean((got - whole) ** 2) < 0.05 * y.var()  # packs, and so draws, may differ with the order of the rows
    PipelineModel(stages=[model]).write().overwrite().save(folder)
    assert predictions(PipelineModel.load(folder), df) == pytest.approx(got)


def test_draws():
    w = forest.drawn(7 << 33, 3, 100_000, 42, True)
    assert w.mean() == pytest.approx(1.0, abs=0.02) and (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert (w == forest.drawn(7 << 33, 3, 100_000, 42, True)).all() and (w != forest.drawn(7 << 33, 4, 100_000, 42, True)).any()


def test_constant_and_missing_labels(spark):
    df = spark.createDataFrame([(i, Vectors.dense([float(i)]), 3.0 if i % 2 else None) for i in range(20)], ["id", "features", "label"])
    model = models.random_forest("label", 4, 0).fit(df)
    assert set(predictions(model, df)) == {3.0} and model.featureImportances.toArray().tolist() == [0.0]
    with pytest.raises(ValueError, match="no rows"):
        models.random_forest("label").fit(df.where("label IS NULL"))


def test_rows_by_bin_are_sorted_in_time_linear_in_the_rows(monkeypatch):
    rng = np.random.default_rng(7)
    x, sorted_ = rng.integers(0, 256, 5000).astype(np.uint8), []
    plain = np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **k: sorted_.append(a.dtype.itemsize) or plain(a, **k))
    for k in (1, 300, 1 << 16):
        slot = rng.integers(0, k, 5000)
        assert (forest._by_bin(slot, x, k) == plain(slot * 256 + x, kind="stable")).all()
    assert max(sorted_) <= 2  # numpy sorts whole numbers of 16 bits digit by digit
    slot = rng.integers(0, 1 << 20, 5000)
    assert (forest._by_bin(slot, x, 1 << 20) == plain(slot * 256 + x, kind="stable")).all()


def test_passes_write_splits_and_no_rows(data, monkeypatch):
    """Rows are binned once; what passes store does not grow with trees times rows."""
    x, y, df = data
    written, plain = [], forest.durable
    monkeypatch.setattr(forest, "durable", lambda rows, name: written.append(name) or plain(rows, name))
    monkeypatch.setattr(forest, "SMALL", 60)
    model = models.random_forest("label", 2, 4, leaf_rows=3, bootstrap=False).fit(df)
    assert written.count("splits") >= 2 and set(written) == {"packs", "splits", "forest"}
    assert predictions(model, df) == pytest.approx(plain_tree(x, y, 4, 3))
