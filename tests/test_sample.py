import hashlib

import pytest
from pyspark.sql import functions as F

from tasador.operators import sample


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_random_sample_is_exact_and_independent_of_partitions(spark):
    df = spark.range(5000)
    want = sorted(sorted(range(5000), key=lambda i: hashlib.md5(f"{i}|42".encode()).hexdigest())[:300])
    assert ids(sample.random_sample(df, 300)) == want
    assert ids(sample.random_sample(df.repartition(7), 300)) == want
    assert sample.random_sample(spark.range(10), 300).count() == 10


def test_split_is_disjoint_and_whole(spark):
    train, test = sample.train_test(spark.range(5000))
    assert ids(train.union(test)) == list(range(5000))
    assert 850 < test.count() < 1150


def test_folds_cover_all_rows_and_differ_from_inner_folds(spark):
    df = sample.add_inner_fold(sample.add_fold(spark.range(5000)), "inner")
    counts = df.groupBy("fold", "inner").count().collect()
    assert len(counts) == 25 and all(120 < r["count"] < 290 for r in counts)


def test_allocation_adds_up():
    counts = {0: 3, 1: 10, 2: 7, 3: 81}
    shares = sample.allocate(counts, 50)
    assert sum(shares.values()) == 50 and all(0 <= shares[s] <= counts[s] for s in counts)


@pytest.mark.parametrize("parts", [1, 9])
def test_stratified_sample(spark, parts):
    """A third of the rows share one price; some have none."""
    price = F.when(F.col("id") % 3 == 0, 100.0).when(F.col("id") % 50 != 1, F.col("id").cast("double"))
    df = spark.range(6000).withColumn("price_usd", price).repartition(parts)
    got = sample.stratified_sample(df, 600)
    assert got.count() == 600 and got.columns == df.columns
    hot = got.where("price_usd = 100").count()
    assert 150 < hot < 250
    want = sample.stratified_sample(spark.range(6000).withColumn("price_usd", price), 600)
    assert ids(got) == ids(want)
    deciles = [r["count"] for r in got.where("id % 3 != 0 AND price_usd IS NOT NULL").groupBy((F.col("price_usd") / 1000).cast("int")).count().collect()]
    assert max(deciles) - min(deciles) < 30


def test_small_data_is_returned_whole(spark):
    df = spark.range(20).withColumn("price_usd", F.col("id").cast("double"))
    assert sample.stratified_sample(df, 50) is df
