import json
import logging

import pytest
from pyspark.sql import functions as F

from tasador.operators import reports, scoring
from tasador.operators.clean import CleaningRules
from tasador.plans import analysis, ingest
from tasador.sources import listing_files
from tasador.sources.driver_tables import COUNTRIES, listings
from tasador.sources.listing_store import ListingStore
from conftest import SF


@pytest.fixture(scope="module")
def run(spark):
    from tasador.session import scratch_path

    root = scratch_path(spark, "run")
    store = ListingStore(spark, f"{root}/store")
    raw = f"{root}/raw"
    reports.write_csv(listings(spark, SF), raw)
    stored = ingest.ingest(spark, raw, store, CleaningRules(countries=COUNTRIES))
    return root, store, stored, analysis.analyse(store, root, "core")


def test_ingest_stores_the_cleaned_rows(run):
    assert run[2] == 377


def test_registry_has_all_figures(run):
    _, store, _, result = run
    rows = store.results_history().collect()
    assert {r.model_name for r in rows} == {"Linear Regression", "Ridge"}
    for r in rows:
        assert all(r[c] is not None for c in r.asDict() if c.startswith(("test_", "cv_")))
        assert set(json.loads(r.feature_importance)) == set(result.importance[r.model_name])
    assert store.configs().count() == 2


def test_report_files(spark, run):
    root, _, stored, _ = run
    document = json.loads(spark.read.text(f"{root}/reports/data_exploration", wholetext=True).first()[0])
    assert document["shape"][0] == stored and document["target_stats"]["count"] == stored
    table = spark.read.option("header", True).csv(f"{root}/reports/model_comparison").collect()
    assert table[0].asDict().keys() == {"model", "cv_r2", "cv_rmse", "cv_mae"} and float(table[0].cv_r2) >= float(table[1].cv_r2)
    lines = [r[0] for r in spark.read.text(f"{root}/reports/analysis_report").collect()]
    assert lines[0].startswith("# ") and sum(x.startswith("| ") for x in lines) == 3 and f"{stored}" in lines[2]
    for name, size in (("price_histogram", 50), ("price_density", 200), ("price_surface_sample", stored)):
        assert spark.read.option("header", True).csv(f"{root}/reports/{name}").count() == size
    for name, size in (("test_comparison", 2), ("train_metrics", 2), ("residual_histogram", 30), ("top_features", 14)):
        assert spark.read.option("header", True).csv(f"{root}/reports/{name}").count() == size
    groups = spark.read.option("header", True).csv(f"{root}/reports/feature_importance")
    assert {r.feature_group for r in groups.collect()} <= {"surface", "rooms", "bedrooms", "bathrooms", "operation", "property", "province", "department"}


def test_saved_models_score_raw_spellings(spark, run, caplog):
    root, store, _, result = run
    spark.createDataFrame([("x",)], "value string").write.text(f"{root}/models/broken_pipeline/metadata")
    with caplog.at_level(logging.WARNING):
        models = scoring.load_models(spark, f"{root}/models")
    assert set(models) == {"Linear Regression", "Ridge"} and "broken" in caplog.text
    rows = store.read_listings().drop("price_usd", "id", "created_at", "raw_data")
    shouted = rows.withColumns({c: F.concat(F.lit("  "), F.upper(c)) for c in scoring.REQUEST_TEXTS})
    pick = lambda df: {r.property_id: r.predicted_price for r in scoring.score(models["Ridge"], df).collect()}
    assert pick(shouted) == pytest.approx(pick(rows))
    with pytest.raises(ValueError, match="province"):
        scoring.score(models["Ridge"], rows.drop("province"))


def test_no_models(spark, folder):
    with pytest.raises(LookupError):
        scoring.load_models(spark, folder)


def test_saved_sample(spark, folder):
    rows = spark.range(500).select(F.col("id").cast("string").alias("property_id"), F.col("id").cast("double").alias("price_usd"))
    ingest.save_sample(rows, folder, 100)
    assert spark.read.option("header", True).csv(folder).count() == 100
    assert spark.read.option("header", True).csv(folder).count() == 100


def test_ranking_and_importance_tables(spark):
    scores = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "model string, cv_r2 double")
    assert reports.best_model(scores, "cv_r2").first().model == "c"
    assert reports.best_model(scores.where("model != 'c'"), "cv_r2").first().model == "a"
    weights = {f"cat_low__t_{i}": float(i) for i in range(30)} | {"num__rooms": 3.0}
    frame = reports.importance_frame(spark, weights)
    assert [r.feature for r in reports.top_features(frame).collect()] == [f"t_{i}" for i in range(29, 14, -1)]
    assert [tuple(r) for r in reports.top_groups(frame).collect()] == [("t", 435.0), ("rooms", 3.0)]


def test_report_lines_of_the_test_scores(spark):
    scores = spark.createDataFrame([("a", 0.85, 10.04, 5.5), ("b", 0.5, 20.0, 7.25)], "model string, r2 double, rmse double, mae double")
    lines = [r.line for r in reports.report_lines(scores, "r2", "rmse", "mae", 12, 4).orderBy("position").collect()]
    assert lines[3].endswith("a (R² 0.8500, RMSE 10.0400, MAE 5.5000), explains 85.0 % of the variation: excelente") and lines[-2:] == ["| a | 0.8500 | 10.0400 | 5.5000 |", "| b | 0.5000 | 20.0000 | 7.2500 |"]


def test_from_files_without_operation_type_to_the_report(spark, tmp_path):
    """Missing columns are stored as empty texts, which are categories like any other."""
    from tasador.operators.clean import CleaningRules
    from tasador.plans import analysis
    from tasador.sources.driver_tables import COUNTRIES, listings
    from tasador.sources.listing_store import ListingStore

    raw, store = str(tmp_path / "raw"), ListingStore(spark, str(tmp_path / "store"))
    reports.write_csv(listings(spark, "/root/testdata/sf0.001").drop("operation_type"), raw, single=False)
    assert ingest.ingest(spark, raw, store, CleaningRules(countries=COUNTRIES)) > 100
    result = analysis.analyse(store, str(tmp_path / "out"), kind="core")
    assert set(result.models) == {"Linear Regression", "Ridge"}
    assert any(n == "operation_type_" for n in result.importance["Ridge"])
    assert "Best model" in "\n".join(r.value for r in spark.read.text(str(tmp_path / "out" / "reports" / "analysis_report")).collect())


def test_the_raw_files_are_accounted_for(spark, run, tmp_path):
    root, store, stored, result = run
    source = listing_files.read_csv(spark, f"{root}/raw")
    analysis.write_reports(analysis.model_rows(store.read_listings()), result, str(tmp_path), source=source)
    document = json.loads(spark.read.text(f"{tmp_path}/data_exploration", wholetext=True).first()[0])
    assert document["original_dataset_info"]["total_rows"] == 1500 and document["original_dataset_info"]["n_files"] == 1


def test_derived_columns_come_back_from_the_raw_rows(spark, run):
    _, store, stored, _ = run
    rows = analysis.model_rows(store.read_listings(), engineered=True)
    assert "raw_data" not in rows.columns and dict(rows.dtypes)["surface_category"] == "string"
    got = rows.agg(*[F.count(c) for c in analysis.ENGINEERED]).first()
    assert got[0] == got[2] == got[3] == stored and 0 < got[1] < stored
    same = F.abs(F.col("surface_ratio") - F.col("surface_covered") / F.col("surface_total")) < 1e-9
    assert rows.where("surface_covered IS NOT NULL").where(~same).count() == 0
    odd = spark.createDataFrame([(1.0, "{"), (2.0, None), (3.0, '{"surface_ratio": "x", "total_rooms": 4}')], "price_usd double, raw_data string")
    assert [(r.surface_ratio, r.total_rooms) for r in analysis.model_rows(odd, engineered=True).orderBy("price_usd").collect()] == [(None, None), (None, None), (None, 4.0)]
