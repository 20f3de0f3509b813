"""Saved models and batch scoring of new listings."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.functions.text import model_slug, model_title
from tasador.operators.clean import normalise_columns, require

log = logging.getLogger(__name__)

# Columns of a scoring request.
REQUEST_TEXTS = ("operation_type", "property_type", "province", "department")
REQUEST_NUMBERS = ("surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms")
SUFFIX = "_pipeline"


def save_model(model: PipelineModel, folder: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/{model_slug(name)}{SUFFIX}"
    model.write().overwrite().save(path)
    return path


def saved_paths(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the saved models below ``folder``, found by their metadata on any file system."""
    try:
        files = spark.read.text(f"{folder.rstrip('/')}/*{SUFFIX}/metadata")
        rows = files.select(F.input_file_name().alias("file")).distinct().collect()
    except AnalysisException:
        return []
    return sorted({r["file"].rsplit("/metadata/", 1)[0] for r in rows})


def load_models(spark: SparkSession, folder: str) -> dict[str, PipelineModel]:
    """All readable models by name; unreadable ones are skipped with a warning, none at all raises."""
    models = {}
    for path in saved_paths(spark, folder):
        try:
            models[model_title(path.rsplit("/", 1)[-1])] = PipelineModel.load(path)
        except Exception as error:
            log.warning("could not load %s: %s", path, error)
    if not models:
        raise LookupError(f"no saved models below {folder}")
    return models


def score(model: PipelineModel, requests: DataFrame, name: str = "predicted_price") -> DataFrame:
    """Predict every request. Texts are normalised as in training, so spellings match."""
    require(requests, *REQUEST_TEXTS, *REQUEST_NUMBERS)
    ready = normalise_columns(requests, REQUEST_TEXTS)
    return model.transform(ready).select(*requests.columns, F.col("prediction").alias(name))
