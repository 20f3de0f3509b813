"""Preprocessing of all folds from statistics that add up is that of each fold by itself."""

import uuid

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tasador.operators import encode, evaluate, fold_statistics, models, quantiles
from tasador.operators.fold_statistics import ALL, learn_sets


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 600
    pick = lambda values: [None if v == "" else str(v) for v in rng.choice(values, n)]
    rows = list(zip(
        range(n), pick(["Casa", "PH", "Lote", "Torre", ""]), pick(["a", "b", "b", ""]), pick(["P1", "P1", "P2", "P3", ""]), pick([f"D{i}" for i in range(80)]),
        [None if x < -1 else float(x) for x in rng.normal(size=n)], [7] * n, [None] * n, (rng.normal(200, 30, n)).tolist(),
    ))
    kind = "id long, kind string, operation string, province string, department string, a double, same int, none double, price_usd double"
    df = spark.createDataFrame(rows, kind).withColumn("kind", F.when((F.col("kind") == "Torre") & (F.col("id") > 30), F.lit(None)).otherwise(F.col("kind")))
    return evaluate.mark_folds(df).cache()


def one_by_one(df):
    """The same stages, each fitted by itself on the rows."""
    numbers, low, high = encode.feature_roles(df, "price_usd")
    names = [[f"{p}{c}" for c in low] for p in ("_filled_", "_label_", "_index_", "cat_low__")]
    outs = [f"num__{c}" for c in numbers], names[3], [f"cat_high__{c}" for c in high]
    stages = [
        encode.NumericBlock(inputCols=numbers, outputCols=outs[0]), encode.ModeImputer(inputCols=low, outputCols=names[0]),
        encode.CategoryLabels(inputCols=names[0], outputCols=names[1]), StringIndexer(inputCols=names[1], outputCols=names[2], handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=names[2], outputCols=names[3], dropLast=True), encode.FoldTargetEncoder(inputCols=high, outputCols=outs[2], labelCol="price_usd"),
        VectorAssembler(inputCols=[*outs[0], *outs[1], *outs[2]], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(df)


def vectors(encoded):
    return {r["id"]: r["features"].toArray().tolist() for r in encoded.collect()}


@pytest.mark.parametrize("exact_rows", [250_000, 20])
def test_every_set_is_that_of_its_rows(frame, monkeypatch, exact_rows):
    whole = quantiles.exact_quantiles
    monkeypatch.setattr(fold_statistics, "exact_quantiles", lambda *a, **k: whole(*a, **k, exact_rows=exact_rows))
    fitted = learn_sets(frame, "price_usd", [0, 2, 4, ALL])
    for k, model in fitted.items():
        rows = frame if k == ALL else frame.where(F.col(encode.OUTER_FOLD) != k)
        want = one_by_one(rows)
        held = frame.withColumn(encode.INNER_FOLD, F.when(F.col(encode.OUTER_FOLD) != k, F.col(encode.INNER_FOLD)))
        got, wanted = (encode.encode(m, held, ["id"]) for m in (model, want))
        assert encode.feature_names(got) == encode.feature_names(wanted)
        got, wanted = vectors(got), vectors(wanted)
        assert all(got[i] == pytest.approx(wanted[i], rel=1e-9, abs=1e-12) for i in wanted) and len(got) == len(wanted)


def jobs(spark, work):
    name = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_the_sets(spark, frame):
    two, six = (jobs(spark, lambda k=k: learn_sets(frame, "price_usd", k)) for k in ([0, 1], [0, 1, 2, 3, 4, ALL]))
    assert two == six <= 20


def test_own_fold_of_a_held_out_row_is_not_seen(frame):
    """Other targets and numbers in a fold change nothing in the set that leaves it out."""
    inside = F.col(encode.OUTER_FOLD) == 1
    changed = frame.withColumns({"price_usd": F.when(inside, 9e9).otherwise(F.col("price_usd")), "a": F.when(inside, -5.0).otherwise(F.col("a"))})
    rows = frame.where(~inside)
    one, other = (vectors(encode.encode(learn_sets(df, "price_usd", [1])[1], rows, ["id"])) for df in (frame, changed))
    assert all(one[i] == pytest.approx(other[i], rel=1e-12) for i in one)


def test_tables_without_rows_of_a_kind(spark):
    numbers = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 4.0)], "id long, rooms double, price_usd double")
    model = learn_sets(numbers, "price_usd")[ALL]
    assert vectors(encode.encode(model, numbers, ["id"])) == {1: [0.0], 2: [0.0]}
    texts = spark.createDataFrame([(1, None, 3.0), (2, None, 4.0)], "id long, kind string, price_usd double")
    model = learn_sets(texts, "price_usd")[ALL]
    assert vectors(encode.encode(model, texts, ["id"])) == {1: [1.0], 2: [1.0]}


def test_folds_learned_before_are_used(frame):
    chosen = {"Ridge": models.Ridge(labelCol="price_usd")}
    train = frame.drop(encode.INNER_FOLD, encode.OUTER_FOLD, "none")
    fitted = learn_sets(evaluate.mark_folds(train, folds=3), "price_usd", range(3))
    one, other = (sorted(map(tuple, evaluate.cross_validate(train, chosen, folds=3, fitted=f).collect())) for f in (fitted, None))
    assert [r[:3] for r in one] == [r[:3] for r in other] and [r[3] for r in one] == pytest.approx([r[3] for r in other])
