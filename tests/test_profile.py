import pyarrow as pa
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tasador.operators import profile


def test_describe_matches_pandas(raw, raw_pandas):
    got = profile.describe(raw, "price").first()
    assert list(got) == pytest.approx(raw_pandas.price.describe().tolist())


def test_price_statistics(raw, raw_pandas):
    p = raw_pandas.price
    assert list(profile.price_statistics(raw, "price").first()) == pytest.approx([p.min(), p.max(), p.mean(), p.median()])


def test_null_counts_and_percent(raw, raw_pandas):
    want = raw_pandas.isnull().sum()
    assert {r["column"]: r["n_missing"] for r in profile.null_counts(raw).collect()} == want.to_dict()
    got = profile.null_percent(raw).collect()
    share = (want / len(raw_pandas) * 100)[lambda s: s > 0].sort_values(ascending=False)
    assert [r["percent"] for r in got] == pytest.approx(share.tolist())
    assert [r["above_alarm"] for r in got] == [p > 20 for p in share]


def test_histogram_matches_numpy(raw, raw_pandas):
    counts, edges = np.histogram(raw_pandas.price.dropna(), bins=50)
    got = profile.histogram(raw, "price").orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["low"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    got = profile.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [0, 0, 2, 0] and got[0]["low"] == 1.5 and got[3]["high"] == 2.5
    assert sum(r["n"] for r in profile.histogram(df.limit(0), "v", 4).collect()) == 0


@pytest.mark.parametrize("shape", ["normal", "outliers", "two_heaps"])
def test_density_matches_the_sum_over_all_pairs(spark, shape):
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, 3000)
    if shape == "outliers":
        x[:3] = [4000.0, -900.0, 77.0]
    if shape == "two_heaps":
        x[:1000] = 1e4
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(4)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    got = [r["density"] for r in profile.density(df, "v").orderBy("point").collect()]
    assert np.abs(np.array(got) - want).max() < 1e-12 * want.max()


def test_density_without_spread(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert {r["density"] for r in profile.density(df, "v").collect()} == {None}


def test_correlations_match_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 1, (300, 3)), columns=["a", "b", "c"])
    pdf["b"] += pdf.a * 1e6
    pdf.loc[::7, "c"] = np.nan
    pdf["flat"] = 3.0
    df = spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf])
    want = pdf.corr()
    for a, b, r in profile.correlations(df).collect():
        if "flat" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_correlations_without_variance_in_the_common_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (1.0, 6.0)], "a double, b double")
    assert {(r.a, r.b): r.r for r in profile.correlations(df).collect()}["a", "b"] is None


def test_correlations_of_one_column(spark):
    assert profile.correlations(spark.createDataFrame([(1.0,)], "a double")).count() == 0


def test_column_types_and_shape(raw):
    kinds = {r["name"]: r["class"] for r in profile.column_types(raw).collect()}
    assert kinds["price"] == "numeric" and kinds["l1"] == "text"
    assert tuple(profile.shape(raw).first()) == (200, 12)


def test_trim_uses_quantiles_of_the_whole_frame(raw, raw_pandas):
    p = raw_pandas
    want = p[(p.surface_total < p.surface_total.quantile(0.99)) & (p.price < p.price.quantile(0.99))]
    assert profile.trim_plot(raw, ("surface_total", "price")).count() == len(want)


def test_price_by_group(raw, raw_pandas):
    got = {r["l2"]: r for r in profile.price_by(raw, ["l2"], "price").collect()}
    for k, g in raw_pandas.groupby("l2"):
        assert got[k]["n"] == len(g) and got[k]["share"] == len(g) / 200
        assert got[k]["mean_price"] == pytest.approx(g.price.mean()) and got[k]["median_price"] == pytest.approx(g.price.median())


def test_locations_and_departments(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("a", "y"), ("a", "w")], "province string, department string")
    assert [tuple(r) for r in profile.locations(df).collect()] == [("a", "w"), ("a", "y"), ("b", "x")]
    assert {r[0] for r in profile.departments_of(df, "a").collect()} == {"w", "y"}
    assert {r[0] for r in profile.provinces(df).collect()} == {"a", "b"}


def test_correlations_of_many_columns_with_gaps(spark):
    """As many pairs as a plan with an expression for each could not hold."""
    rng = np.random.default_rng(2)
    size = 300
    x = rng.normal(size=(400, size)) + rng.normal(size=(400, 1)) + np.arange(size) * 1e5
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 3.0
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(size)])
    df = spark.createDataFrame(pa.Table.from_pandas(frame)).repartition(5)
    got = profile.correlations(df).toPandas().pivot(index="a", columns="b", values="r").loc[frame.columns, frame.columns].to_numpy()
    want = frame.corr().to_numpy()
    assert np.allclose(got, want, atol=1e-6, equal_nan=True) and np.isnan(got[7]).all()
