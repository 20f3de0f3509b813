"""Derived columns of cleaned listings. Each one is added only if its inputs exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.numeric import ratio
from tasador.operators.clean import require

# Labels of the surface bins, smallest first.
SURFACE_LABELS = ("Muy Pequeña", "Pequeña", "Mediana", "Grande", "Muy Grande")


def _has(df: DataFrame, *names: str) -> bool:
    return all(n in df.columns for n in names)


def add_surface_ratio(df: DataFrame) -> DataFrame:
    if not _has(df, "surface_covered", "surface_total"):
        return df
    return df.withColumn("surface_ratio", F.coalesce(ratio(F.col("surface_covered"), F.col("surface_total")), F.lit(1.0)))


def add_total_rooms(df: DataFrame) -> DataFrame:
    if not _has(df, "bedrooms", "bathrooms"):
        return df
    return df.withColumn("total_rooms", F.col("bedrooms") + F.col("bathrooms"))


def add_room_density(df: DataFrame) -> DataFrame:
    if not _has(df, "rooms", "surface_total"):
        return df
    return df.withColumn("room_density", ratio(F.col("rooms"), F.col("surface_total")))


def add_location(df: DataFrame) -> DataFrame:
    require(df, "l2", "l3")
    return df.withColumns({"province": F.col("l2"), "department": F.col("l3")})


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    low, high = df.agg(F.min(column), F.max(column)).first()
    return None if low is None else (float(low), float(high))


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin 1 .. ``bins``, closed on the right; the lowest value is in bin 1.

    If all values are equal the range is widened on both sides and they meet in the middle bin.
    """
    if low == high:
        return F.when(value.isNotNull(), F.lit((bins + 1) // 2))
    number = F.lit(None).cast("int")
    for k in range(bins, 0, -1):
        edge = high if k == bins else low + (high - low) * k / bins
        number = F.when(value <= F.lit(edge), F.lit(k)).otherwise(number)
    return number


def add_surface_category(
    df: DataFrame, surface_range: tuple[float, float] | None = None, labels: Sequence[str] = SURFACE_LABELS
) -> DataFrame:
    """``surface_bin`` (for ordering) and ``surface_category``; a known range saves one pass."""
    if not _has(df, "surface_total"):
        return df
    limits = surface_range or value_range(df, "surface_total")
    if limits is None:
        number = F.lit(None).cast("int")
    else:
        number = equal_width_bin(F.col("surface_total"), *limits, len(labels))
    texts = F.array(*[F.lit(t) for t in labels])
    return df.withColumn("surface_bin", number).withColumn("surface_category", F.get(texts, F.col("surface_bin") - 1))


def create_features(df: DataFrame, surface_range: tuple[float, float] | None = None) -> DataFrame:
    with_rooms = add_room_density(add_total_rooms(add_surface_ratio(df)))
    return add_surface_category(add_location(with_rooms), surface_range)
