"""Numeric expressions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column: Spark would treat it as a large number."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATS)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def finite(value: Column) -> Column:
    """NULL for NaN and the infinities."""
    return F.when(F.abs(value) < float("inf"), value)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, NULL where it is missing or not finite."""
    return finite(F.try_divide(top.cast("double"), bottom.cast("double")))


def log_price(price: Column) -> Column:
    return F.log1p(price)


def numeric_columns(df: DataFrame, drop=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def text_columns(df: DataFrame, drop=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in drop]
