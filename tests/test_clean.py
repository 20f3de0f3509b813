import logging

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tasador.operators import clean
from tasador.operators.clean import CleaningRules
from tasador.operators.features import create_features, equal_width_bin
from tasador.plans import ingest
from tasador.sources.driver_tables import COUNTRIES, listings


def pandas_clean(df: pd.DataFrame) -> pd.DataFrame:
    df = df[(df.l1 == "Argentina") & df.operation_type.isin(["Venta", "Alquiler"])].dropna(subset=["price", "surface_total"])
    q1, q3 = df.price.quantile(0.25), df.price.quantile(0.75)
    df = df[df.price.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
    return df[(df.surface_total > 0) & (df.surface_total < 2000)]


def test_chain_keeps_the_rows_that_pandas_keeps(raw, raw_pandas):
    got = clean.clean_listings(raw)
    want = pandas_clean(raw_pandas)
    assert sorted(r.id for r in got.collect()) == sorted(want.id)
    assert 0 < got.count() <= raw.count()


def test_stage_counts_on_the_stand_in_listings(spark):
    df = listings(spark, SF)
    counts = [df.count()]
    for step in (
        lambda d: clean.keep_countries(d, COUNTRIES), clean.keep_operations, lambda d: clean.drop_missing(clean.name_price(d)),
        clean.drop_price_outliers, clean.keep_surfaces,
    ):
        df = step(df)
        counts.append(df.count())
    assert counts == [1500, 616, 414, 406, 396, 377]


def test_null_country_is_dropped_and_match_is_exact(spark):
    df = spark.createDataFrame([("Argentina",), ("argentina",), (None,)], "l1 string")
    assert clean.keep_countries(df).count() == 1


def test_required_and_optional_columns(spark, caplog):
    df = spark.createDataFrame([(1.0,)], "price double")
    with pytest.raises(ValueError, match="l1"):
        clean.keep_countries(df)
    with caplog.at_level(logging.WARNING):
        assert clean.keep_operations(df) is df
    assert "operation_type" in caplog.text


def test_existing_price_usd_is_not_replaced(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "price double, price_usd double")
    assert clean.name_price(df).columns == ["price", "price_usd"]


def test_nothing_left_gives_an_empty_frame(raw):
    out = ingest.process(raw, CleaningRules(countries=("Nowhere",)))
    assert out.count() == 0 and "surface_category" in out.columns


def test_features_match_pandas(spark, raw, raw_pandas):
    got = ingest.process(raw).toPandas().set_index("id").sort_index()
    want = pandas_clean(raw_pandas).set_index("id").sort_index()
    labels = ["Muy Pequeña", "Pequeña", "Mediana", "Grande", "Muy Grande"]
    assert list(got.surface_category) == list(pd.cut(want.surface_total, bins=5, labels=labels).astype(str))
    assert got.surface_ratio.tolist() == (want.surface_covered / want.surface_total).fillna(1).tolist()
    assert got.room_density.tolist() == (want.rooms / want.surface_total).tolist()
    total = want.bedrooms + want.bathrooms
    assert got.total_rooms.fillna(-1).tolist() == total.fillna(-1).tolist()
    assert set(got.department) == {"La Plata", "O'Higgins", "Nan"}
    assert set(got.province) <= {"Buenos Aires", "Córdoba", "Santa Fe"}


def test_ratios_never_raise(spark):
    df = spark.createDataFrame([(0.0, 5.0, 1.0), (10.0, None, 2.0)], "surface_total double, surface_covered double, rooms double")
    df = df.withColumns({"l2": F.lit("a"), "l3": F.lit("b")})
    rows = create_features(df).select("surface_ratio", "room_density").collect()
    assert [tuple(r) for r in rows] == [(1.0, None), (1.0, 0.2)]


def test_constant_column_meets_in_the_middle_bin(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [r[0] for r in df.select(equal_width_bin(F.col("v"), 3.0, 3.0, 5)).collect()] == [3, 3, None]


def test_bounds_reach_the_scan(spark, folder, raw):
    raw.write.parquet(folder)
    plan = clean.keep_between(spark.read.parquet(folder), (1.0, 2.0), "price")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(price,1.0)" in plan and "LessThanOrEqual(price,2.0)" in plan
