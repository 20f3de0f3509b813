"""The fast queries beside their SQL on the smallest tables; tools/check_queries.py runs them all."""

from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

FAST = (
    "country_filter", "price_outlier_filter", "event_outlier_filter", "clean_listings", "surface_category", "normalised_texts", "correlations",
    "price_by_location", "log_price_density", "stratified_sample", "train_test_split", "target_encoding_of_training_rows", "feature_vectors",
    "ridge", "test_metrics", "key_from_row_position", "duplicate_keys", "number_formats",
)


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert sorted(df.columns) == sorted(names)
    assert got == sorted(result.fetchall(), key=repr) and got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
