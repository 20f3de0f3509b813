"""Regression models on a vector column, as unfitted Spark ML estimators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.operators.encode import feature_names
from tasador.operators.forest import NodeForest
from tasador.operators.leafwise import LeafwiseBoosting

# Penalties, tree counts, depths, seed.
SEED = 42
RIDGE_ALPHA = 1.0
LASSO_ALPHA = 0.1
FOREST_TREES, FOREST_DEPTH = 50, 15
GRADIENT_ROUNDS, GRADIENT_DEPTH, GRADIENT_RATE = 100, 3, 0.1
BOOSTED_ROUNDS, BOOSTED_LEAVES, BOOSTED_LEAF_ROWS = 200, 31, 20

#: Split candidates of a column; more bins give finer splits at a higher cost. An argument of every tree model.
MAX_BINS = 64


class Ridge(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares plus ``alpha`` times the squared coefficients, on the raw sums.

    ``LinearRegression`` penalises the mean loss of a target scaled by its deviation, so its
    parameter is ``alpha / n * deviation``; both are known only when the rows are. ``solver`` is ``normal`` (one pass, for up to 4096 features)
    or ``l-bfgs`` (many passes, for more); both reach the same coefficients.
    """

    solver = Param(Params._dummy(), "solver", "normal or l-bfgs", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty on the sum of squares", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=None, solver=None, featuresCol=None, labelCol=None, predictionCol=None):
        super().__init__()
        self._setDefault(alpha=RIDGE_ALPHA, solver="normal")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        label = F.col(self.getLabelCol())
        n, population, sample = dataset.agg(F.count(label), F.stddev_pop(label), F.stddev_samp(label)).first()
        normal = self.getOrDefault("solver") == "normal"
        deviation = (population if normal else sample) or 0.0
        return LinearRegression(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
            regParam=self.getOrDefault("alpha") / n * deviation, elasticNetParam=0.0, standardization=False,
            solver=self.getOrDefault("solver"), tol=1e-10, maxIter=1000,
        ).fit(dataset)


def linear(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=0.0)


def moments(dataset: DataFrame, features: str, label: str) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Means of features and label, and covariances of the features among themselves and with the label.

    Two passes; each task adds up its rows and sends the square of the number of features, whatever its rows.
    """
    rows = dataset.where(F.col(label).isNotNull()).select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))

    def parts(center: np.ndarray | None):
        def run(batches):
            total = None
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                z = np.column_stack([x, batch.column("y").to_numpy(), np.ones(batch.num_rows)])
                if center is not None:
                    z = z - center
                own = z.T @ z if center is not None else z.sum(0, keepdims=True)
                total = own if total is None else total + own
            if total is not None:
                i, j = np.indices(total.shape)
                yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

        sums = rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        out = np.zeros((1 + max((r.i for r in sums), default=0), 1 + max((r.j for r in sums), default=0)))
        for r in sums:
            out[r.i, r.j] = r.v
        return out

    total = parts(None)[0]
    n = total[-1]
    mean = total / n
    mean[-1] = 0.0
    squares = parts(mean) / n
    return mean[:-2], float(mean[-2]), squares[:-2, :-2], squares[:-2, -2]


def descend(covariance: np.ndarray, with_label: np.ndarray, alpha: float, rounds: int) -> np.ndarray:
    """Coordinate descent for half the mean squared error plus ``alpha`` times the sum of absolute coefficients, to the optimality conditions."""
    weights, slope = np.zeros(len(with_label)), with_label.astype(float).copy()  # slope: gradient of the fit, with_label - covariance @ weights
    scale = max(float(np.abs(with_label).max(initial=0.0)), alpha, 1e-300)
    for _ in range(rounds):
        for k in range(len(weights)):
            own = covariance[k, k]
            if own <= 0:
                continue
            pull = slope[k] + own * weights[k]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / own
            if new != weights[k]:
                slope -= covariance[:, k] * (new - weights[k])
                weights[k] = new
        off = np.where(weights != 0, np.abs(slope - alpha * np.sign(weights)), np.maximum(np.abs(slope) - alpha, 0.0))
        if off.max(initial=0.0) <= 1e-12 * scale:
            break
    return weights


class Lasso(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Half the mean squared error plus ``alpha`` times the sum of absolute coefficients.

    Solved on the moments of the rows, whose number is the square of that of the features. Iterations on the rows stop short of the optimum
    when columns depend on one another, as complete one-hot blocks do.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty on the sum of absolute coefficients", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most rounds over the coefficients", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, alpha=None, maxIter=None, featuresCol=None, labelCol=None, predictionCol=None):
        super().__init__()
        self._setDefault(alpha=LASSO_ALPHA, maxIter=20_000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LassoModel":
        mean, label_mean, covariance, with_label = moments(dataset, self.getFeaturesCol(), self.getLabelCol())
        weights = descend(covariance, with_label, self.getOrDefault("alpha"), self.getOrDefault("maxIter"))
        return self._copyValues(LassoModel(weights=[float(w) for w in weights], constant=float(label_mean - mean @ weights)))


class LassoModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "coefficients", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "intercept", TypeConverters.toFloat)
    alpha = Lasso.alpha
    maxIter = Lasso.maxIter

    @keyword_only
    def __init__(self, *, weights=None, constant=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("constant")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(w) for w in self.getOrDefault("weights")])
        products = F.zip_with(vector_to_array(F.col(self.getFeaturesCol())), weights, lambda x, w: x * w)
        return dataset.withColumn(self.getPredictionCol(), F.aggregate(products, F.lit(self.intercept), lambda a, p: a + p))


def lasso(label: str, alpha: float = LASSO_ALPHA) -> Lasso:
    return Lasso(labelCol=label, alpha=alpha)


def random_forest(label: str, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, bins: int = MAX_BINS, leaf_rows: int = 1, bootstrap: bool = True) -> NodeForest:
    """A forest whose nodes are a table. ``depth`` 0 is no bound."""
    return NodeForest(labelCol=label, trees=trees, depth=depth, bins=bins, leafRows=leaf_rows, bootstrap=bootstrap, seed=SEED)


def gradient_boosting(
    label: str, rounds: int = GRADIENT_ROUNDS, depth: int = GRADIENT_DEPTH, rate: float = GRADIENT_RATE, bins: int = MAX_BINS
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=rate, maxBins=bins, seed=SEED, checkpointInterval=20
    )


def boosted(label: str, rounds: int = BOOSTED_ROUNDS, leaves: int = BOOSTED_LEAVES, leaf_rows: int = BOOSTED_LEAF_ROWS, bins: int = MAX_BINS) -> LeafwiseBoosting:
    """Leaf-wise boosting: no bound on the depth, but on the leaves of a tree and the rows of a leaf."""
    return LeafwiseBoosting(labelCol=label, rounds=rounds, leaves=leaves, leafRows=leaf_rows, bins=bins, rate=GRADIENT_RATE)


def catalogue(kind: str = "full", label: str = "price_usd", bins: int = MAX_BINS, leaf_rows: int = 1) -> dict[str, Estimator]:
    """Named unfitted models: ``core`` (two), ``full`` (five) or ``trainer`` (five, library defaults). ``leaf_rows`` is for the deep forest of ``trainer``."""
    kinds = {
        "core": lambda: {"Linear Regression": linear(label), "Ridge": Ridge(alpha=RIDGE_ALPHA, labelCol=label)},
        "full": lambda: {
            "Linear Regression": linear(label),
            "Ridge": Ridge(alpha=RIDGE_ALPHA, labelCol=label),
            "Lasso": lasso(label),
            "Random Forest": random_forest(label, bins=min(bins, 256)),
            "Boosted Trees": boosted(label, bins=min(bins, 256)),
        },
        "trainer": lambda: {
            "Linear Regression": linear(label),
            "Ridge Regression": Ridge(alpha=RIDGE_ALPHA, labelCol=label),
            "Lasso Regression": lasso(label, alpha=1.0),
            "Random Forest": random_forest(label, trees=100, depth=0, bins=min(bins, 256), leaf_rows=leaf_rows),
            "Gradient Boosting": gradient_boosting(label, bins=bins),
        },
    }
    return kinds[kind]()


def hyperparameters(model: Estimator) -> dict[str, bool | int | float | str]:
    """Parameters by name; numbers stay numbers."""
    return {p.name: v if isinstance(v, bool | int | float) else str(v) for p, v in model.extractParamMap().items()}


def importance(model, encoded: DataFrame) -> dict[str, float] | None:
    """Importance by full feature name: that of the trees, or the size of the coefficients; none for vectors without names."""
    if not feature_names(encoded):
        return None
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        weights = abs(model.coefficients.toArray())
    else:
        return None
    return {n: float(w) for n, w in zip(feature_names(encoded), weights)}
