import numpy as np
import pytest

from tasador.operators import quantiles
from pyspark.sql import functions as F

from tasador.operators.lookup import lookup
from tasador.operators.quantiles import exact_quantiles, grouped_quantiles

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0)


def columns():
    rng = np.random.default_rng(1)
    n = 20_000
    heavy = np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 2, n))
    return {
        "plain": rng.normal(0, 1, n), "heavy": heavy, "two": rng.choice([1.0, 2.0], n), "wide": np.exp(rng.normal(0, 8, n)),
        "constant": np.full(n, 4.0), "signed": np.where(rng.random(n) < 0.34, -1e12, rng.integers(0, 50, n).astype(float)),
    }


@pytest.fixture(scope="module")
def frame(spark):
    data = columns()
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), ", ".join(f"{c} double" for c in data))
    return df.repartition(4).cache(), data


@pytest.mark.parametrize("exact_rows", [100_000, 40])
def test_whole_columns(frame, exact_rows):
    df, data = frame
    got = exact_quantiles(df, {c: PROBS for c in data}, exact_rows)
    for c, values in data.items():
        assert got[c] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-12), c


def test_missing_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (4.0, None), (None, None)], "a double, b double")
    assert exact_quantiles(df, {"a": (0.5,), "b": (0.5,)}) == {"a": [2.5], "b": [None]}


@pytest.mark.parametrize("exact_rows", [100_000, 60])
def test_groups_with_a_hot_one(spark, exact_rows):
    rng = np.random.default_rng(2)
    n = 6_000
    keys = np.where(rng.random(n) < 0.35, "hot", rng.choice(["a", "b", "c"], n))
    values = np.where(keys == "hot", rng.integers(0, 4, n).astype(float), rng.normal(0, 1, n))
    df = spark.createDataFrame(list(zip(keys.tolist(), values.tolist())), "k string, v double")
    df = df.withColumn("k", F.when(F.col("k") != "c", F.col("k")))
    got = {r["k"]: r["quantiles"] for r in grouped_quantiles(df, ["k"], "v", (0.5, 0.9), exact_rows).collect()}
    for k in ("hot", "a", "b", "c"):
        assert got[None if k == "c" else k] == pytest.approx(np.quantile(values[keys == k], (0.5, 0.9)).tolist(), rel=1e-12)
    assert len(got) == 4


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_lookup_is_the_same_on_both_ways(spark, broadcast_rows):
    keys = ["hot"] * 400 + [f"k{i % 90}" for i in range(600)] + ["absent"] * 5 + [None] * 5
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string")
    table = df.where("key IS NOT NULL AND key != 'absent'").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = lookup(df, table, "key", "n", broadcast_rows=broadcast_rows).select("id", "key", "top").collect()
    tops = {r["key"]: r["top"] for r in table.collect()}
    assert sorted(map(tuple, got), key=str) == sorted([(i, k, tops.get(k)) for i, k in enumerate(keys)], key=str)


def test_hot_group_in_the_shuffled_branch(spark):
    """One group has nine of ten rows; the table of groups is not broadcast as a whole, its hot part is."""
    rows = spark.range(3000).selectExpr("CASE WHEN id % 10 > 0 THEN 'hot' ELSE concat('g', id % 70) END AS k", "CAST(hash(id) AS DOUBLE) AS v").repartition(6)
    want = {r.k: r.quantiles for r in quantiles.grouped_quantiles(rows, ["k"], "v", [0.25, 0.5]).collect()}
    got = {r.k: r.quantiles for r in quantiles.grouped_quantiles(rows, ["k"], "v", [0.25, 0.5], exact_rows=50, broadcast_rows=0).collect()}
    assert got == want
    groups = rows.groupBy("k").count()
    plan = quantiles._join_groups(rows, groups, ["k"], "count", broadcast_rows=0)
    sizes = [n for n in plan.where("k = 'hot'").rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    assert sum(sizes) == 2700 and max(sizes) < 1000
