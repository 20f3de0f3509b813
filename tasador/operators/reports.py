"""Report tables and documents behind the charts."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tasador.functions.numeric import numeric_columns, text_columns
from tasador.functions.text import clean_feature_name, feature_group, fixed, quality_label
from tasador.operators.profile import describe, null_counts
from tasador.sources.listing_files import dataset_info

# Rows of the importance charts, columns of the comparison.
TOP_GROUPS = 20
TOP_FEATURES = 15
COMPARISON_COLUMNS = ("model", "cv_r2", "cv_rmse", "cv_mae")


def comparison(summary: DataFrame, score: str = "cv_r2") -> DataFrame:
    """Models, best first; equal scores by name. Takes the means of the cross-validation."""
    means = summary.withColumnsRenamed({f"cv_{m}_mean": f"cv_{m}" for m in ("r2", "rmse", "mae")})
    return means.select(*COMPARISON_COLUMNS).orderBy(F.desc(score), "model")


def test_comparison(metrics: DataFrame) -> DataFrame:
    """Test error and R² per model, in no order."""
    return metrics.select("model", "rmse", "r2")


def best_model(scores: DataFrame, score: str) -> DataFrame:
    return scores.orderBy(F.desc(score), "model").limit(1)


def importance_frame(spark: SparkSession, importance: dict[str, float]) -> DataFrame:
    rows = list(importance.items())
    named = spark.createDataFrame(rows, "feature string, importance double")
    return named.withColumn("feature", clean_feature_name(F.col("feature")))


def group_importance(features: DataFrame) -> DataFrame:
    """Importance summed over features whose names start with the same word."""
    return features.groupBy(feature_group(F.col("feature")).alias("feature_group")).agg(F.sum("importance").alias("importance"))


def top(features: DataFrame, rows: int, name: str) -> DataFrame:
    return features.orderBy(F.desc("importance"), name).limit(rows)


def top_groups(features: DataFrame, rows: int = TOP_GROUPS) -> DataFrame:
    return top(group_importance(features), rows, "feature_group")


def top_features(features: DataFrame, rows: int = TOP_FEATURES) -> DataFrame:
    return top(features, rows, "feature")


def with_quality(scores: DataFrame, r2: str) -> DataFrame:
    return scores.withColumn("quality", quality_label(F.col(r2)))


# The keys of the exploration document, in order.
DOCUMENT_KEYS = ("shape", "columns", "dtypes", "missing_values", "numeric_columns", "categorical_columns")


def exploration_document(df: DataFrame, target: str = "price_usd", source: DataFrame | None = None) -> str:
    """Shape, columns, types, missing values and target figures as JSON text; ``source`` adds the rows, files and bytes of a frame that reads files directly."""
    missing = null_counts(df).collect()
    figures = (
        [missing[0]["n_rows"] if missing else 0, len(df.columns)], df.columns, dict(df.dtypes),
        {r["column"]: r["n_missing"] for r in missing}, numeric_columns(df), text_columns(df),
    )
    document = dict(zip(DOCUMENT_KEYS, figures))
    if source is not None:
        document["original_dataset_info"] = dataset_info(source).first().asDict()
    if target in df.columns:
        document["target_stats"] = describe(df, target).first().asDict()
    return json.dumps(document, indent=2, default=str, ensure_ascii=False)


def report_lines(scores: DataFrame, r2: str, rmse: str, mae: str, n_rows: int, decimals: int = 0) -> DataFrame:
    """Markdown report as numbered lines: size, best model with its quality, table of all models.

    ``decimals`` is that of the errors; R² always has four.
    """
    order = Window.orderBy(F.desc(r2), "model")
    ranked = scores.withColumn("_rank", F.row_number().over(order))
    cells = [F.col("model"), fixed(F.col(r2), 4), fixed(F.col(rmse), decimals), fixed(F.col(mae), decimals)]
    table = ranked.select((F.col("_rank") + 7).alias("position"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    head = [(1, "# Predictive analysis report"), (2, ""), (3, f"- Listings: {n_rows}"), (5, ""),
            (6, "| model | R² | RMSE | MAE |"), (7, "|---|---|---|---|")]
    best = with_quality(ranked.where("_rank = 1"), r2).select(
        F.lit(4).alias("position"),
        F.concat(F.lit("- Best model: "), F.col("model"), F.lit(" (R² "), fixed(F.col(r2), 4), F.lit(", RMSE "), fixed(F.col(rmse), decimals), F.lit(", MAE "), fixed(F.col(mae), decimals),
                 F.lit("), explains "), fixed(100 * F.col(r2), 1), F.lit(" % of the variation: "), F.col("quality")).alias("line"),
    )
    return scores.sparkSession.createDataFrame(head, "position int, line string").unionByName(best).unionByName(table)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.orderBy("position").select("line").coalesce(1).write.mode("overwrite").text(path)


def write_document(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """CSV with header; ``single`` puts a small table in one file, ``False`` writes in parallel."""
    out = df.coalesce(1) if single else df
    (
        out.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
