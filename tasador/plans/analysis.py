"""From stored listings to compared models, stored results and report files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.operators.clean import drop_columns, drop_missing
from tasador.operators.encode import encode
from tasador.operators.evaluate import Training, cross_validate, mark_folds, metrics, prediction_pairs, summarise_folds
from tasador.operators.fold_statistics import ALL, learn_sets
from tasador.operators.models import catalogue, hyperparameters, importance
from tasador.operators.profile import density, histogram, residual_histogram, scatter
from tasador.operators.reports import (
    best_model, comparison, exploration_document, importance_frame, report_lines, test_comparison, top_features, top_groups, write_csv, write_document,
    write_lines,
)
from tasador.operators.sample import FOLDS, random_sample, train_test
from tasador.operators.scoring import save_model
from tasador.session import durable
from tasador.sources.listing_store import ListingStore

# Fixed value: the version of the stored results.
VERSION = "1.0_cv5_target_enc"
NOT_FEATURES = ("created_at", "raw_data")


@dataclass
class Comparison:
    """Outcome of training: fitted pipelines, fold figures, train and test figures, test predictions."""

    models: dict[str, PipelineModel]
    preprocessing: PipelineModel
    by_fold: DataFrame
    train_metrics: DataFrame
    test_metrics: DataFrame
    predictions: dict[str, DataFrame]
    importance: dict[str, dict[str, float] | None]
    parameters: dict[str, dict]

    def summary(self) -> DataFrame:
        return summarise_folds(self.by_fold)


METRIC_SCHEMA = "model string, n bigint, rmse double, mae double, r2 double"


# The derived columns that a stored listing only has inside its raw row, and their types.
ENGINEERED = {"surface_ratio": "double", "total_rooms": "double", "room_density": "double", "surface_category": "string"}


def with_engineered(df: DataFrame, raw: str = "raw_data") -> DataFrame:
    """The derived columns of stored listings, read back from the raw row: it is parsed once, as a variant; what it lacks or cannot be read is missing."""
    parsed = df.withColumn("_raw", F.try_parse_json(raw))
    return parsed.withColumns({n: F.try_variant_get("_raw", f"$.{n}", kind) for n, kind in ENGINEERED.items()}).drop("_raw")


def model_rows(df: DataFrame, target: str = "price_usd", engineered: bool = False) -> DataFrame:
    """Rows with a target and without the columns that training never uses; the keys stay as identity, not as features. ``engineered`` adds the derived columns as features."""
    kept = drop_missing(df, [target])
    return drop_columns(with_engineered(kept) if engineered else kept, NOT_FEATURES)


def compare_models(
    rows: DataFrame, models: Mapping[str, Estimator] | None = None, target: str = "price_usd", identity: str = "id",
    folds: int = FOLDS, parallelism: int = 1, side_by_side: int = 1,
) -> Comparison:
    """Cross-validate on the training part, refit on all of it, score train and test rows.

    Preprocessing is learned once, for all folds and the final fit together, and shared by all models, of which ``side_by_side`` are trained at a time.
    """
    models = models or catalogue("full", target)
    spark = rows.sparkSession
    train, test = train_test(rows, identity=identity)
    marked = mark_folds(train, identity, folds)
    by_set = learn_sets(marked, target, [*range(folds), ALL])
    by_fold = cross_validate(train, models, target, identity, folds, parallelism=parallelism, fitted=by_set, side_by_side=side_by_side)
    done = {r["model"] for r in by_fold.select("model").distinct().collect()}
    fitted = by_set[ALL]
    keep = [identity, target]
    fit_rows = encode(fitted, marked, keep).persist(StorageLevel.MEMORY_AND_DISK)
    train_rows = encode(fitted, train, keep).persist(StorageLevel.MEMORY_AND_DISK)
    test_rows = encode(fitted, test, keep).persist(StorageLevel.MEMORY_AND_DISK)
    out = Comparison({}, fitted, by_fold, None, None, {}, {}, {})
    training = Training(spark, side_by_side)

    def final(name: str) -> tuple:
        model = models[name].fit(fit_rows)
        predictions = durable(model.transform(test_rows).select(*keep, "prediction"), "predictions")
        on_train = metrics(model.transform(train_rows), target, "prediction").first()
        return model, cleaned(importance(model, fit_rows)), predictions, on_train, metrics(predictions, target, "prediction").first()

    try:
        for encoded in (fit_rows, train_rows, test_rows):
            encoded.count()  # stored before the models share them
        found = training.every({n: lambda n=n: final(n) for n in models if n in done})
        for name, (model, weights, predictions, _, _) in found.items():
            out.models[name] = PipelineModel(stages=[*fitted.stages, model])
            out.importance[name], out.parameters[name], out.predictions[name] = weights, hyperparameters(models[name]), predictions
    finally:
        for encoded in (fit_rows, train_rows, test_rows):
            encoded.unpersist()
    out.train_metrics = spark.createDataFrame([(n, *r[3]) for n, r in found.items()], METRIC_SCHEMA)
    out.test_metrics = spark.createDataFrame([(n, *r[4]) for n, r in found.items()], METRIC_SCHEMA)
    return out


def cleaned(weights: dict[str, float] | None) -> dict[str, float] | None:
    """Importance by feature name without its block."""
    return None if weights is None else {n.split("__")[-1]: w for n, w in weights.items()}


def registry_rows(result: Comparison) -> list[dict]:
    """One row per model for the results table, with the keys that the table reads."""
    test = {r["model"]: r for r in result.test_metrics.collect()}
    rows = []
    for r in result.summary().collect():
        if r["model"] not in test:
            continue
        figures = {k: r[k] for k in r.asDict() if k != "model"}
        figures.update({f"test_{m}": test[r["model"]][m] for m in ("rmse", "mae", "r2")})
        rows.append(
            {"model_name": r["model"], "model_version": VERSION, "metrics": figures,
             "hyperparameters": result.parameters[r["model"]], "feature_importance": result.importance[r["model"]]}
        )
    return rows


def store_comparison(result: Comparison, store: ListingStore) -> None:
    store.store_results(registry_rows(result))
    store.store_configs(
        [{"model_name": n, "config_name": f"config_v_{VERSION}", "parameters": p,
          "preprocessing_steps": {"strategy": "out-of-fold target encoding for columns with many categories"}}
         for n, p in result.parameters.items()]
    )


def write_reports(
    rows: DataFrame, result: Comparison, folder: str, target: str = "price_usd", identity: str = "property_id", source: DataFrame | None = None,
) -> None:
    """All report files: exploration (with the files of ``source``, if given), comparison, train and test figures, report text, and the data behind each chart."""
    spark, root = rows.sparkSession, folder.rstrip("/")
    write_document(spark, exploration_document(rows, target, source), f"{root}/data_exploration")
    table = comparison(result.summary())
    write_csv(table, f"{root}/model_comparison")
    write_lines(report_lines(table, "cv_r2", "cv_rmse", "cv_mae", rows.count()), f"{root}/analysis_report")
    write_csv(test_comparison(result.test_metrics), f"{root}/test_comparison")
    write_csv(result.train_metrics, f"{root}/train_metrics")
    write_csv(histogram(rows, target), f"{root}/price_histogram")
    write_csv(density(rows, target), f"{root}/price_density")
    write_csv(scatter(random_sample(rows, identity=identity)), f"{root}/price_surface_sample")
    best = best_model(table, "cv_r2").first()
    if best is None:
        return
    predictions = result.predictions[best["model"]]
    write_csv(prediction_pairs(predictions, target), f"{root}/predicted_actual", single=False)
    write_csv(residual_histogram(predictions, target, "prediction"), f"{root}/residual_histogram")
    weights = result.importance[best["model"]]
    if weights:
        write_csv(top_groups(importance_frame(spark, weights)), f"{root}/feature_importance")
        write_csv(top_features(importance_frame(spark, weights)), f"{root}/top_features")


def analyse(
    store: ListingStore, folder: str, kind: str = "full", target: str = "price_usd", source: DataFrame | None = None, engineered: bool = False,
) -> Comparison:
    """Train the named models on the stored listings; store results, save pipelines, write reports.

    ``property_id`` decides splits and folds: unlike ``id`` it is the same after every load. ``source`` is the frame that reads the raw files, for the account of them in the
    exploration document; ``engineered`` trains with the derived columns as well.
    """
    rows = model_rows(store.read_listings(), target, engineered)
    result = compare_models(rows, catalogue(kind, target), target, "property_id")
    store_comparison(result, store)
    result.preprocessing.write().overwrite().save(f"{folder.rstrip('/')}/models/preprocessor")
    for name, model in result.models.items():
        save_model(model, f"{folder.rstrip('/')}/models", name)
    write_reports(rows, result, f"{folder.rstrip('/')}/reports", target, source=source)
    return result
