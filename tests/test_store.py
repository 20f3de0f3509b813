import json

import pytest
from pyspark.sql import functions as F

from tasador.plans import ingest
from tasador.sources.listing_files import add_property_id
from tasador.sources.listing_store import DuplicateKeys, ListingStore, NoListings


@pytest.fixture
def store(spark, folder):
    return ListingStore(spark, folder)


@pytest.fixture(scope="module")
def processed(raw):
    return add_property_id(ingest.process(raw)).cache()


def test_new_store_has_empty_tables(store):
    with pytest.raises(NoListings):
        store.read_listings()
    assert store.results_history().count() == 0 and store.configs().count() == 0


def test_store_replaces_all(spark, store, processed):
    assert store.store_listings(processed) == processed.count()
    few = processed.limit(3)
    store.store_listings(few)
    store.store_listings(few)
    got = ListingStore(spark, store.root).read_listings()
    assert got.count() == 3 and got.columns[:2] == ["id", "property_id"]
    assert store.read_listings(limit=2).count() == 2 and store.read_listings(limit=0).count() == 3
    assert [r.property_id for r in store.read_listings(order_by="property_id").collect()] == sorted(r.property_id for r in few.collect())


def test_a_failed_load_keeps_the_old_one(store, processed):
    store.store_listings(processed)
    with pytest.raises(DuplicateKeys):
        store.store_listings(processed.unionByName(processed.limit(1)))
    assert store.read_listings().count() == processed.count()
    with pytest.raises(Exception):
        store.store_listings(processed.withColumn("rooms", F.raise_error(F.lit("broken input")).cast("double")))
    assert store.read_listings().count() == processed.count()


def test_a_store_can_be_rewritten_from_itself(store, processed):
    store.store_listings(processed)
    store.store_listings(store.read_listings().where("price_usd > 100000"))
    assert 0 < store.read_listings().count() < processed.count()


def test_projection_of_missing_values_and_numbers(spark, store):
    df = spark.createDataFrame([("a", None, 2.7, 9.5)], "property_id string, province string, rooms double, price_usd double")
    store.store_listings(df)
    row = store.read_listings().first()
    assert row.province == "" and row.rooms == 2 and row.bedrooms is None and row.property_type == "" and row.created_at is not None
    assert json.loads(row.raw_data) == {"property_id": "a", "province": None, "rooms": 2.7, "price_usd": 9.5}


def test_empty_load_reads_as_no_listings(store, processed):
    store.store_listings(processed.limit(0))
    with pytest.raises(NoListings):
        store.read_listings()


def test_results_history(store):
    store.store_results([{"model_name": "Ridge", "model_version": "1", "metrics": {"test_r2": 0.5}, "hyperparameters": {"alpha": 1.0}}])
    store.store_results([
        {"model_name": "Ridge", "model_version": "2", "metrics": {"cv_r2_mean": 0.7}, "hyperparameters": {}, "feature_importance": {"rooms": 1.5}},
        {"model_name": "Lasso", "model_version": "2", "metrics": {}, "hyperparameters": {}},
    ])
    assert [r.id for r in store.results_history().collect()] == [3, 2, 1]
    ridge = store.results_history("Ridge").collect()
    assert [r.model_version for r in ridge] == ["2", "1"]
    assert ridge[0].test_r2 is None and ridge[0].cv_r2_mean == 0.7 and json.loads(ridge[0].feature_importance) == {"rooms": 1.5}
    assert json.loads(ridge[1].hyperparameters) == {"alpha": 1.0} and ridge[1].train_date is not None


def test_configs(store):
    store.store_configs([{"model_name": "Ridge", "config_name": "c", "parameters": {"a": 1}, "preprocessing_steps": {"s": "t"}}])
    row = store.configs().first()
    assert row.is_active == 1 and row.feature_engineering is None and json.loads(row.preprocessing_steps) == {"s": "t"}
