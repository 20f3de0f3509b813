"""From raw files to the stored listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tasador.operators.clean import CleaningRules, fit_cleaning, staged
from tasador.operators.features import create_features
from tasador.operators.reports import write_csv
from tasador.operators.sample import SAMPLE_ROWS, stratified_sample
from tasador.sources.listing_files import load_listings
from tasador.sources.listing_store import ListingStore


def process(raw: DataFrame, rules: CleaningRules = CleaningRules(), stage: bool = True) -> DataFrame:
    """Clean and enrich raw listings.

    Cleaning learns four scalars from two columns before it can filter. With ``stage`` the rows
    that pass the first filters are written once to the shared folder, so that the source, which
    may be CSV or a join, is read only once; without it the source is read twice and
    nothing is written. A raw frame may already be narrow and columnar: then stage nothing.
    """
    if stage:
        raw = staged(raw, rules)
    fitted = fit_cleaning(raw, rules)
    return create_features(fitted.apply(raw), fitted.surface_range)


def ingest(spark: SparkSession, path: str, store: ListingStore, rules: CleaningRules = CleaningRules(), multiline: bool | None = None) -> int:
    """Load, clean, enrich and store; returns the stored rows. Errors are raised."""
    return store.store_listings(process(load_listings(spark, path, multiline), rules))


def save_sample(raw: DataFrame, save_to: str, size: int = SAMPLE_ROWS, target: str = "price_usd", identity: str = "property_id") -> None:
    """Write a stratified sample of ``size`` rows as CSV. Only a call of this takes a sample; nothing else does."""
    write_csv(stratified_sample(raw, size, target, identity), save_to, single=False)
