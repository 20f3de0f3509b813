import logging
import time

import numpy as np
import pytest
from pyspark.ml import Estimator
from pyspark.ml.linalg import Vectors

from tasador.operators import evaluate, models
from tasador.operators.sample import train_test
from tasador.plans import analysis


@pytest.fixture(scope="module")
def arrays(spark):
    rng = np.random.default_rng(42)
    x, noise = rng.normal(0, 1, (120, 5)), rng.normal(0, 1, 120)
    y = x @ np.array([3.0, -2.0, 0.5, 0.0, 1.0]) * 10 + 40 + noise
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    return x, y, df.repartition(3).cache()


def test_least_squares(arrays):
    x, y, df = arrays
    model = models.linear("label").fit(df)
    want = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)[0]
    assert [*model.coefficients, model.intercept] == pytest.approx(want.tolist(), rel=1e-6)


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_ridge_is_the_closed_form(arrays, alpha):
    x, y, df = arrays
    model = models.Ridge(alpha=alpha, labelCol="label").fit(df)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(5), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(want.tolist(), rel=1e-6)


def test_lasso_meets_its_optimality_conditions(arrays):
    x, y, df = arrays
    w = np.array(models.lasso("label", alpha=2.0).fit(df).coefficients)
    xc, yc = x - x.mean(0), y - y.mean()
    gradient = xc.T @ (yc - xc @ w) / len(y)
    assert w[3] == 0 and abs(gradient[3]) <= 2.0
    used = w != 0
    assert gradient[used] == pytest.approx(2.0 * np.sign(w[used]), abs=1e-4)


def test_lasso_on_complete_blocks(spark):
    """Columns of a block add up to one, so weights are not unique in the fit and the penalty decides."""
    rng = np.random.default_rng(1)
    kind, x = rng.integers(0, 3, 300), rng.normal(size=300)
    z = np.column_stack([x, np.eye(3)[kind]])
    y = 200_000 + 5_000 * x + np.array([1_200.0, 0.0, -700.0])[kind] + rng.normal(size=300) * 100
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(z, y)], ["features", "label"])
    model = models.lasso("label", alpha=2.0).fit(df.repartition(3))
    w = np.array(model.coefficients)
    zc, yc = z - z.mean(0), y - y.mean()
    gradient = zc.T @ (yc - zc @ w) / len(y)
    assert (w[1:] == 0).any() and np.all(np.abs(gradient[w == 0]) <= 2.0 + 1e-6)
    assert gradient[w != 0] == pytest.approx(2.0 * np.sign(w[w != 0]), abs=1e-6)
    predicted = [r.prediction for r in model.transform(df).collect()]
    assert predicted == pytest.approx((z @ w + model.intercept).tolist())


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_both_ridge_solvers_agree(arrays, alpha):
    _, _, df = arrays
    normal, steps = (models.Ridge(alpha=alpha, solver=s, labelCol="label").fit(df) for s in ("normal", "l-bfgs"))
    assert list(normal.coefficients) == pytest.approx(list(steps.coefficients), rel=1e-5)


@pytest.mark.parametrize("kind,size", [("core", 2), ("full", 5), ("trainer", 5)])
def test_catalogues(spark, kind, size):
    chosen = models.catalogue(kind)
    assert len(chosen) == size and all(isinstance(m, Estimator) for m in chosen.values())


def test_metrics(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(10, 3, 50), rng.normal(10, 3, 50)
    df = spark.createDataFrame([(float(p), float(q)) for p, q in zip(a, b)], "y double, p double")
    got = evaluate.metrics(df, "y", "p").first()
    want = [50, np.sqrt(((a - b) ** 2).mean()), np.abs(a - b).mean(), 1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum()]
    assert list(got) == pytest.approx(want) and got["rmse"] >= 0 and got["mae"] >= 0


def test_r2_of_a_constant_target(spark):
    df = spark.createDataFrame([("same", 2.0, 2.0), ("off", 2.0, 3.0)], "k string, y double, p double")
    assert {r["k"]: r["r2"] for r in evaluate.metrics(df, "y", "p", ["k"]).collect()} == {"same": 1.0, "off": 0.0}


def test_tree_models_beat_a_bound_and_have_importance(rows):
    train, test = train_test(rows)
    small = {"Random Forest": models.random_forest("price_usd", 10, 6), "Gradient Boosting": models.gradient_boosting("price_usd", 10)}
    result = analysis.compare_models(rows, small, folds=2)
    for r in result.test_metrics.collect():
        assert r["r2"] > 0.4 and r["n"] == test.count()
        weights = result.importance[r["model"]]
        assert sum(weights.values()) == pytest.approx(1.0) and len(weights) == 14
        assert result.predictions[r["model"]].count() == test.count()
    assert {r["n"] for r in result.train_metrics.collect()} == {train.count()}


class Broken(Estimator):
    def _fit(self, dataset):
        raise RuntimeError("no fit")


def test_a_failing_model_is_skipped(rows, caplog):
    with caplog.at_level(logging.ERROR):
        result = analysis.compare_models(rows, {"Broken": Broken(), "Ridge": models.Ridge(labelCol="price_usd")}, folds=2, parallelism=2)
    assert list(result.models) == ["Ridge"] and "Broken" in caplog.text
    assert result.by_fold.count() == 2
    summary = result.summary().first()
    folds = [r["r2"] for r in result.by_fold.collect()]
    assert summary["cv_r2_mean"] == pytest.approx(np.mean(folds)) and summary["cv_r2_std"] == pytest.approx(np.std(folds))


def test_folds_are_the_same_whatever_the_parallelism(rows):
    chosen = {"Linear Regression": models.linear("price_usd")}
    train, _ = train_test(rows)
    one = evaluate.cross_validate(train, chosen, folds=3).collect()
    three = evaluate.cross_validate(train.repartition(5), chosen, folds=3, parallelism=3).collect()
    assert [tuple(r)[1:3] for r in one] == [tuple(r)[1:3] for r in three]
    assert [r["r2"] for r in one] == pytest.approx([r["r2"] for r in three], rel=1e-6)


class Slow(Estimator):
    """Fails at once on the rows of the first fold that asks, and works without end on all others."""

    def __init__(self):
        super().__init__()
        self.asked = []

    def copy(self, extra=None):
        return self

    def _fit(self, dataset):
        self.asked.append(1)
        if len(self.asked) == 2:
            time.sleep(3)
            raise RuntimeError("no fit")
        dataset.sparkSession.range(0, 10**13, 1, 2).selectExpr("sum(id * id % 7)").collect()


def test_a_failing_model_is_cancelled_where_it_still_runs(rows, caplog):
    chosen = {"Slow": Slow(), "Ridge": models.Ridge(labelCol="price_usd"), "Linear Regression": models.linear("price_usd")}
    start = time.time()
    with caplog.at_level(logging.ERROR):
        found = evaluate.cross_validate(train_test(rows)[0], chosen, folds=2, parallelism=2, side_by_side=3)
    assert {r.model for r in found.collect()} == {"Ridge", "Linear Regression"} and found.count() == 4
    assert time.time() - start < 120 and caplog.text.count("model Slow failed") == 1


def test_side_by_side_is_one_after_the_other(rows):
    chosen = models.catalogue("core")
    one, other = (analysis.compare_models(rows, chosen, folds=2, side_by_side=n) for n in (1, 2))
    for name in ("by_fold", "train_metrics", "test_metrics"):
        a, b = (sorted(map(tuple, getattr(r, name).collect())) for r in (one, other))
        assert [x[0] for x in a] == [x[0] for x in b] and [x[-1] for x in a] == pytest.approx([x[-1] for x in b])
    assert list(one.models) == list(other.models) == list(chosen)


class Looking(Estimator):
    """Notes how many tables are in the cache when it is asked."""

    def __init__(self):
        super().__init__()
        self.cached = []

    def copy(self, extra=None):
        return self

    def _fit(self, dataset):
        self.cached.append(sum(i.numCachedPartitions() == i.numPartitions() for i in dataset.sparkSession.sparkContext._jsc.sc().getRDDStorageInfo()))
        raise RuntimeError("no fit")


def test_rows_that_models_share_are_stored_before_any_model_is_trained(rows, spark):
    """Else the model that comes first stores them under its tag, and the others fail if it is cancelled."""
    rows.count()
    before = sum(i.numCachedPartitions() == i.numPartitions() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    look = Looking()
    analysis.compare_models(rows, {"Looking": look}, folds=1 + 1)
    assert look.cached[0] > before
