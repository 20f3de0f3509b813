import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tasador.operators import encode, lookup
from tasador.operators.encode import INNER_FOLD


def test_numeric_block_uses_exact_median_and_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5, None), (2.0, 5, None), (4.0, 5, None), (10.0, None, None), (None, 5, None)], "a double, b int, c double")
    model = encode.NumericBlock(inputCols=["a", "b", "c"], outputCols=["x", "y", "z"]).fit(df)
    filled = np.array([1, 2, 4, 10, 3.0])
    got = model.transform(df).select("x", "y", "z").collect()
    assert [r["x"] for r in got] == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert {r["y"] for r in got} == {0.0} and {r["z"] for r in got} == {0.0}


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "t string, empty string")
    assert encode.fit_modes(df, ["t", "empty"]) == {"t": "a", "empty": None}


def small(spark):
    rows = [("Casa", "P1", "D1", 10.0, 100.0), ("PH", "P1", None, 20.0, 300.0), ("Casa", "P2", "D2", None, 200.0), ("Casa", "P2", "D2", 40.0, 250.0)]
    return spark.createDataFrame(rows, "property_type string, province string, department string, surface_total double, price_usd double")


def test_names_order_and_unseen_categories(spark):
    df = small(spark)
    model = encode.preprocessor(df, "price_usd").fit(df)
    encoded = encode.encode(model, df, ["price_usd"])
    assert encode.feature_names(encoded) == [
        "num__surface_total", "cat_low__property_type_Casa", "cat_low__property_type_PH", "cat_high__province", "cat_high__department"
    ]
    new = spark.createDataFrame([("Lote", "P9", None, 25.0)], "property_type string, province string, department string, surface_total double")
    vector = encode.encode(model, new, []).first()[0].toArray()
    assert vector[1] == vector[2] == 0.0 and vector[3] == pytest.approx(212.5)
    assert vector[4] == pytest.approx(300.0)


def reference_encoding(train_c, train_y, c):
    mean, var = train_y.mean(), train_y.var()
    own = train_y[train_c == c]
    if len(own) == 0:
        return mean
    ss = ((own - own.mean()) ** 2).sum()
    low = var * len(own) + ss / len(own)
    trust = var * len(own) / low if low else 0.0
    return trust * own.mean() + (1 - trust) * mean


def encoder_frame(spark, n=400):
    rng = np.random.default_rng(5)
    c = np.where(rng.random(n) < 0.34, "hot", rng.choice([f"c{i}" for i in range(60)], n))
    y = rng.normal(1e6, 3, n) + np.char.str_len(c)
    fold = rng.integers(0, 5, n)
    df = spark.createDataFrame([(i, str(c[i]), float(y[i]), int(fold[i])) for i in range(n)], f"id int, c string, y double, {INNER_FOLD} int")
    return df, c, y, fold


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_target_encoding_of_both_paths(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", broadcast_rows)
    df, c, y, fold = encoder_frame(spark)
    model = encode.FoldTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y").fit(df)
    inside = {r["id"]: r["e"] for r in model.transform(df).collect()}
    outside = {r["id"]: r["e"] for r in model.transform(df.drop(INNER_FOLD)).collect()}
    for i in range(len(c)):
        others = fold != fold[i]
        assert inside[i] == pytest.approx(reference_encoding(c[others], y[others], c[i]), rel=1e-11)
        assert outside[i] == pytest.approx(reference_encoding(c, y, c[i]), rel=1e-11)


def test_own_targets_do_not_leak(spark):
    df, *_ = encoder_frame(spark)
    changed = df.withColumn("y", F.when(F.col(INNER_FOLD) == 2, F.col("y") * 7).otherwise(F.col("y")))
    encoder = encode.FoldTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y")
    pick = lambda d: {r["id"]: r["e"] for r in encoder.fit(d).transform(d).where(f"{INNER_FOLD} = 2").collect()}
    before, after = pick(df), pick(changed)
    assert before == pytest.approx(after, rel=1e-12)


def test_held_out_rows_with_an_empty_fold_use_all_training_rows(spark):
    df, c, y, _ = encoder_frame(spark)
    model = encode.FoldTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y").fit(df)
    held = df.withColumn(INNER_FOLD, F.lit(None).cast("int"))
    got = {r["id"]: r["e"] for r in model.transform(held).collect()}
    assert got[0] == pytest.approx(reference_encoding(c, y, c[0]), rel=1e-11)


def test_constant_target(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "c string, y double")
    model = encode.FoldTargetEncoder(inputCols=["c"], outputCols=["e"], labelCol="y").fit(df)
    assert {r["e"] for r in model.transform(df).collect()} == {3.0}


def test_saved_preprocessing_gives_the_same_vectors(spark, folder):
    df = small(spark)
    model = encode.preprocessor(df, "price_usd").fit(df)
    model.write().overwrite().save(folder)
    again = PipelineModel.load(folder)
    assert encode.encode(again, df, []).collect() == encode.encode(model, df, []).collect()


def test_stored_columns_that_are_no_features_are_left_out(spark):
    df = spark.createDataFrame([(1, "p", "{}", "Casa", "P", "D", 1.0, 2.0)],
                               "id long, property_id string, raw_data string, property_type string, province string, department string, rooms double, price_usd double")
    assert encode.feature_roles(df, "price_usd") == (["rooms"], ["property_type"], ["province", "department"])
