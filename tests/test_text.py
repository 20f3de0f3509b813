import math
import random

import pytest
from pyspark.sql import functions as F

from tasador.functions import text

WORDS = [
    "  o'higgins GBA-norte 3ambientes\t", "CÓRDOBA ", "ñandú  área", "ph", "", "  ", "x9y z_w", "\nsan juan ", "éÉ-öÖ", "casa/quinta 2a",
]


def test_safe_cast_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (None, "y"), (1.5, "NaN")], "a double, b string")
    got = df.select(text.safe_cast(F.col("a"), "double", -1.0), text.safe_cast(F.col("a"), "string", ""), text.safe_cast(F.col("a"), "int"), text.safe_cast(F.col("b"), "string", "")).collect()
    assert [tuple(r) for r in got] == [(-1.0, "", None, "x"), (-1.0, "", None, "y"), (1.5, "1.5", 1, "NaN")]


def test_title_case_is_that_of_python(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "t string")
    got = [r[0] for r in df.select(text.normalise_text(F.col("t"))).collect()]
    assert got == [w.strip().title() for w in WORDS]


def test_title_case_of_random_texts(spark):
    rng = random.Random(7)
    letters = "abzXYZáÉñÑçüß  \t'-/_.3½中あ\u2003ǅçÀø"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = [r[0] for r in df.select(text.normalise_text(F.col("t"))).collect()]
    assert got == [w.strip().title() for w in words]


def test_missing_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    a, b = df.select(text.normalise_text(F.col("t")), text.normalise_text(F.col("t"), None)).first()
    assert a == "Nan" and b is None


def test_safe_cast(spark):
    df = spark.createDataFrame([(2.7, "2"), (-2.7, "2.5"), (None, "x"), (math.inf, None)], "d double, s string")
    got = df.select(text.safe_cast(F.col("d"), "int"), text.safe_cast(F.col("s"), "int"), text.safe_cast(F.col("s"), "string", "")).collect()
    assert [tuple(r) for r in got] == [(2, 2, "2"), (-2, None, "2.5"), (None, None, "x"), (None, None, "")]


@pytest.mark.parametrize("decimals", [0, 2, 4])
def test_number_formats_are_those_of_python(spark, decimals):
    values = [0.03125, 1234567.891, 0.5, 1.5, 2.5, -1234.565, 0.0, 999999.9999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(text.grouped(F.col("v"), decimals), text.fixed(F.col("v"), decimals)).collect()
    assert [tuple(r) for r in got] == [(f"{v:,.{decimals}f}", f"{v:.{decimals}f}") for v in values]


def test_feature_names(spark):
    df = spark.createDataFrame([("cat_low__property_type_Casa",), ("num__rooms",), ("plain",)], "f string")
    got = df.select(text.clean_feature_name(F.col("f")), text.feature_group(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [("property_type_Casa", "property"), ("rooms", "rooms"), ("plain", "plain")]


def test_quality_label_bounds(spark):
    df = spark.createDataFrame([(0.81,), (0.8,), (0.61,), (0.6,), (-1.0,)], "r double")
    assert [r[0] for r in df.select(text.quality_label(F.col("r"))).collect()] == ["excelente", "buena", "buena", "moderada", "moderada"]


def test_model_names():
    assert text.model_slug("Linear Regression") == "linear_regression"
    assert text.model_title("linear_regression_pipeline") == "Linear Regression"


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(text.row_json(df)).first()[0] == '{"a":1,"b":null}'
