"""Columns with more categories than the driver should hold."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.operators import encode, evaluate, fold_statistics, lookup, models, wide_categories
from tasador.operators.fold_statistics import ALL, learn_sets


def narrow(model, rows):
    encoded = encode.encode(model, rows, ["id"])
    return {r["id"]: r["features"].toArray().tolist() for r in encoded.collect()}


@pytest.fixture(scope="module")
def frame(spark):
    kind = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") * 31 % 40).cast("string")))
    return spark.range(0, 400, 1, 3).select(
        "id", kind.alias("street"), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise("b").alias("operation"), (F.col("id") % 11).cast("double").alias("rooms"),
        F.concat(F.lit("P"), (F.col("id") % 4).cast("string")).alias("province"), (F.col("id") * 13 % 101).cast("double").alias("price_usd"),
    )


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_vectors_are_those_of_few_categories(spark, frame, monkeypatch, folder, broadcast_rows):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", broadcast_rows)
    rows = evaluate.mark_folds(frame)
    plain = learn_sets(rows, "price_usd")[ALL]
    monkeypatch.setattr(fold_statistics, "NAMED", 5)
    wide = learn_sets(rows, "price_usd")[ALL]
    new = frame.withColumn("street", F.when(F.col("id") < 5, F.lit("never seen")).otherwise(F.col("street")))
    for df in (rows, new):
        a, b = narrow(plain, df), narrow(wide, df)
        assert all(a[i] == pytest.approx(b[i]) for i in a) and len(a) == len(b)
    names = [r.feature for r in wide_categories.feature_table(wide, spark).orderBy("position").collect()]
    assert names == encode.feature_names(encode.encode(plain, rows, ["id"]))
    wide.write().overwrite().save(folder)
    assert narrow(PipelineModel.load(folder), new) == narrow(wide, new)
    assert models.importance(None, encode.encode(wide, rows, ["id"])) is None


def test_folds_give_the_same_figures(frame, monkeypatch):
    chosen = {"Ridge": models.Ridge(labelCol="price_usd")}
    plain = sorted(map(tuple, evaluate.cross_validate(frame, chosen, folds=3).collect()))
    monkeypatch.setattr(fold_statistics, "NAMED", 5)
    wide = sorted(map(tuple, evaluate.cross_validate(frame, chosen, folds=3).collect()))
    assert [r[:3] for r in plain] == [r[:3] for r in wide] and [r[3] for r in plain] == pytest.approx([r[3] for r in wide], rel=1e-6)


def test_a_million_categories(spark, monkeypatch):
    """No result of more rows than a few thousand reaches the driver."""
    n = 1_000_000
    rows = spark.range(0, n, 1, 4).select("id", F.concat(F.lit("street "), F.hash("id").cast("string"), F.lit(" "), F.col("id").cast("string")).alias("street"), (F.col("id") % 97).cast("double").alias("price_usd"))
    collect = DataFrame.collect

    def small(self):
        found = collect(self)
        assert len(found) < 5000
        return found

    monkeypatch.setattr(DataFrame, "collect", small)
    model = learn_sets(rows, "price_usd")[ALL]
    encoded = encode.encode(model, rows.where("id % 1000 = 0"), ["id"])
    vectors = [r["features"] for r in encoded.collect()]
    assert len(vectors) == n // 1000 and {v.size for v in vectors} == {n} and {len(v.indices) for v in vectors} == {1}
    assert len({int(v.indices[0]) for v in vectors}) == n // 1000
    table = wide_categories.feature_table(model, spark)
    assert table.agg(F.count("*"), F.countDistinct("position"), F.min("position"), F.max("position")).first()[:] == (n, n, 0, n - 1)
