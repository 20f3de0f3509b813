"""Row filters and text normalisation of raw listings, in the order they must run."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.functions.text import normalise_text
from tasador.operators.quantiles import exact_quantiles
from tasador.session import durable

log = logging.getLogger(__name__)

# The defaults of the cleaning rules.
COUNTRIES = ("Argentina",)
OPERATIONS = ("Venta", "Alquiler")
CRITICAL = ("price_usd", "surface_total")
TEXT_COLUMNS = ("property_type", "l2", "l3", "state_name", "operation_type")
IQR_FACTOR = 1.5
SURFACE_LIMITS = (0.0, 2000.0)


def require(df: DataFrame, *names: str) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing column(s) {absent}; the frame has {df.columns}")


def keep_countries(df: DataFrame, countries: Sequence[str] = COUNTRIES) -> DataFrame:
    require(df, "l1")
    return df.where(F.col("l1").isin(*countries))


def keep_operations(df: DataFrame, operations: Sequence[str] = OPERATIONS) -> DataFrame:
    if "operation_type" not in df.columns:
        log.warning("no column operation_type: all operations kept")
        return df
    return df.where(F.col("operation_type").isin(*operations))


def name_price(df: DataFrame) -> DataFrame:
    return df if "price_usd" in df.columns else df.withColumnRenamed("price", "price_usd")


def drop_missing(df: DataFrame, subset: Sequence[str] = CRITICAL) -> DataFrame:
    require(df, *subset)
    return df.na.drop(subset=list(subset))


def iqr_bounds(df: DataFrame, column: str = "price_usd", factor: float = IQR_FACTOR) -> tuple[float, float] | None:
    q1, q3 = exact_quantiles(df, {column: (0.25, 0.75)})[column]
    if q1 is None:
        return None
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def keep_between(df: DataFrame, bounds: tuple[float, float] | None, column: str = "price_usd") -> DataFrame:
    """Inclusive. The bounds are literals, so the filter reaches the scan."""
    return df.where(F.lit(False)) if bounds is None else df.where(F.col(column).between(*bounds))


def drop_price_outliers(df: DataFrame, column: str = "price_usd", factor: float = IQR_FACTOR) -> DataFrame:
    return keep_between(df, iqr_bounds(df, column, factor), column)


def keep_surfaces(df: DataFrame, limits: tuple[float, float] = SURFACE_LIMITS) -> DataFrame:
    """Exclusive at both ends."""
    low, high = limits
    return df.where((F.col("surface_total") > low) & (F.col("surface_total") < high))


def normalise_columns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS, null_text: str | None = "Nan") -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: normalise_text(F.col(c), null_text) for c in present})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


@dataclass(frozen=True)
class CleaningRules:
    countries: Sequence[str] = COUNTRIES
    operations: Sequence[str] = OPERATIONS
    iqr_factor: float = IQR_FACTOR
    surface_limits: tuple[float, float] = SURFACE_LIMITS
    text_columns: Sequence[str] = TEXT_COLUMNS
    null_text: str | None = "Nan"


@dataclass(frozen=True)
class FittedCleaning:
    """The few scalars that cleaning learns from the data; applying them needs no further pass."""

    rules: CleaningRules
    price_bounds: tuple[float, float] | None
    surface_range: tuple[float, float] | None

    def apply(self, df: DataFrame) -> DataFrame:
        kept = keep_between(select_listings(df, self.rules), self.price_bounds)
        kept = keep_surfaces(kept, self.rules.surface_limits)
        return normalise_columns(kept, self.rules.text_columns, self.rules.null_text)


def select_listings(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The filters that learn nothing: country, operation, price name, missing values."""
    return drop_missing(name_price(keep_operations(keep_countries(df, rules.countries), rules.operations)))


def fit_cleaning(df: DataFrame, rules: CleaningRules = CleaningRules()) -> FittedCleaning:
    """Learn price bounds and the surface range from two narrow cached columns."""
    narrow = select_listings(df, rules).select(*CRITICAL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bounds = iqr_bounds(narrow, "price_usd", rules.iqr_factor)
        surfaces = keep_surfaces(keep_between(narrow, bounds), rules.surface_limits)
        low, high = surfaces.agg(F.min("surface_total"), F.max("surface_total")).first()
        return FittedCleaning(rules, bounds, None if low is None else (low, high))
    finally:
        narrow.unpersist()


def staged(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """The rows that pass the filters which learn nothing, written once to the shared folder, so that the source is read only once."""
    return durable(select_listings(df, rules), "selected")


def clean_listings(df: DataFrame, rules: CleaningRules = CleaningRules(), stage: bool = True) -> DataFrame:
    """The whole chain: country, operation, price name, missing values, price outliers, surfaces, texts.

    Two numbers are learned from two columns before the last filters; ``stage`` keeps the rows for that, without it the source is read twice.
    """
    rows = staged(df, rules) if stage else df
    return fit_cleaning(rows, rules).apply(rows)
