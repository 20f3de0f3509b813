"""Stored tables as Parquet folders: processed listings, model results, model configurations."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tasador.functions.numeric import nan_to_null
from tasador.functions.text import row_json, safe_cast

# Columns of the stored tables.
LISTING_TEXTS = ("property_type", "operation_type", "province", "department")
LISTING_DOUBLES = ("surface_total", "surface_covered", "price_usd")
LISTING_INTS = ("rooms", "bedrooms", "bathrooms")
LISTING_ORDER = (
    "id", "property_id", "property_type", "operation_type", "province", "department",
    "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms", "price_usd",
    "created_at", "raw_data",
)
METRICS = (
    "test_rmse", "test_mae", "test_r2", "cv_rmse_mean", "cv_rmse_std",
    "cv_mae_mean", "cv_mae_std", "cv_r2_mean", "cv_r2_std",
)
LISTINGS_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("property_id", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in LISTING_TEXTS]
    + [T.StructField(c, T.DoubleType()) for c in ("surface_total", "surface_covered")]
    + [T.StructField(c, T.IntegerType()) for c in LISTING_INTS]
    + [T.StructField("price_usd", T.DoubleType()), T.StructField("created_at", T.TimestampType()), T.StructField("raw_data", T.StringType())]
)
RESULTS_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("model_name", T.StringType()), T.StructField("model_version", T.StringType())]
    + [T.StructField("train_date", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in METRICS]
    + [T.StructField(c, T.StringType()) for c in ("hyperparameters", "feature_importance")]
    + [T.StructField("created_at", T.TimestampType())]
)
CONFIG_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("model_name", "config_name", "parameters", "preprocessing_steps", "feature_engineering")]
    + [T.StructField("created_at", T.TimestampType()), T.StructField("is_active", T.IntegerType())]
)
LOADS_SCHEMA = T.StructType(
    [T.StructField("load", T.LongType()), T.StructField("slot", T.StringType()), T.StructField("n_rows", T.LongType()),
     T.StructField("published_at", T.TimestampType())]
)


class DuplicateKeys(ValueError):
    """The frame to store holds a ``property_id`` more than once."""


class NoListings(LookupError):
    """Nothing has been stored yet, or the stored table is empty."""


def stored_listing_columns(df: DataFrame) -> DataFrame:
    """The stored projection: safe casts, empty text for missing texts, the whole row as JSON."""
    df = nan_to_null(df)
    have = set(df.columns)
    column = lambda c: F.col(c) if c in have else F.lit(None)
    made = {
        "id": F.monotonically_increasing_id() + 1,
        "property_id": F.coalesce(column("property_id").cast("string"), F.lit("")),
        **{c: safe_cast(column(c), "string", "") for c in LISTING_TEXTS},
        **{c: safe_cast(column(c), "double") for c in LISTING_DOUBLES},
        **{c: safe_cast(column(c), "int") for c in LISTING_INTS},
        "created_at": F.current_timestamp(),
        "raw_data": row_json(df),
    }
    return df.select(*[made[c].alias(c) for c in LISTING_ORDER])


def duplicate_keys(df: DataFrame, key: Sequence[str] = ("property_id",)) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


class ListingStore:
    """Folder with the three tables.

    Listings are replaced through two slots: the new load is written and checked in the slot
    not in use, then one appended row makes it the current one. A failed load changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.create_tables()

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._path(name))

    def create_tables(self) -> None:
        for name, schema in (
            ("input_data_a", LISTINGS_SCHEMA), ("input_data_b", LISTINGS_SCHEMA), ("input_data_loads", LOADS_SCHEMA),
            ("model_results", RESULTS_SCHEMA), ("model_config", CONFIG_SCHEMA),
        ):
            try:
                self.spark.read.schema(schema).parquet(self._path(name))
            except AnalysisException:
                self.spark.createDataFrame([], schema).write.mode("append").parquet(self._path(name))

    def _current(self):
        loads = self._read("input_data_loads", LOADS_SCHEMA)
        return loads.agg(F.max_by(F.struct("load", "slot", "n_rows"), "load")).first()[0]

    def store_listings(self, df: DataFrame, check_unique: bool = True) -> int:
        """Replace all stored listings; returns the number of rows.

        The keys are checked on the written copy, so that the plan of ``df`` runs only once.
        """
        current = self._current()
        slot = "b" if current and current.slot == "a" else "a"
        path = self._path(f"input_data_{slot}")
        stored_listing_columns(df).write.mode("overwrite").parquet(path)
        written = self.spark.read.schema(LISTINGS_SCHEMA).parquet(path)
        if check_unique:
            repeated = duplicate_keys(written).limit(5).collect()
            if repeated:
                raise DuplicateKeys(f"property_id not unique, for example {[r.property_id for r in repeated]}")
        rows = written.count()
        load = current.load + 1 if current else 1
        self._append([(load, slot, rows)], "load bigint, slot string, n_rows bigint", "published_at", LOADS_SCHEMA, "input_data_loads")
        return rows

    def read_listings(self, limit: int | None = None, order_by: str | None = None) -> DataFrame:
        """The current listings; ``None`` or 0 reads all. Raises if there are none."""
        current = self._current()
        if current is None or current.n_rows == 0:
            raise NoListings(f"no listings stored below {self.root}")
        df = self._read(f"input_data_{current.slot}", LISTINGS_SCHEMA)
        df = df.orderBy(order_by) if order_by else df
        return df.limit(limit) if limit else df

    def _append(self, rows, columns: str, stamp: str, schema: T.StructType, name: str) -> None:
        made = self.spark.createDataFrame(rows, columns).withColumn(stamp, F.current_timestamp())
        if "train_date" in schema.names:
            made = made.withColumn("train_date", F.current_timestamp())
        made.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).coalesce(1).write.mode("append").parquet(self._path(name))

    def _next_id(self, name: str, schema: T.StructType) -> int:
        return (self._read(name, schema).agg(F.max("id")).first()[0] or 0) + 1

    def store_results(self, results: Sequence[Mapping]) -> None:
        """Append one row per model; a mapping has ``model_name``, ``model_version``, ``metrics``,
        ``hyperparameters`` and optionally ``feature_importance``. Absent metrics are NULL."""
        first = self._next_id("model_results", RESULTS_SCHEMA)
        rows = [
            (
                first + i, r["model_name"], r["model_version"],
                *[None if r["metrics"].get(m) is None else float(r["metrics"][m]) for m in METRICS],
                json.dumps(r["hyperparameters"], default=str),
                None if r.get("feature_importance") is None else json.dumps(r["feature_importance"]),
            )
            for i, r in enumerate(results)
        ]
        columns = "id bigint, model_name string, model_version string, " + ", ".join(f"{m} double" for m in METRICS)
        self._append(rows, columns + ", hyperparameters string, feature_importance string", "created_at", RESULTS_SCHEMA, "model_results")

    def store_configs(self, configs: Sequence[Mapping]) -> None:
        """Append one row per configuration, active by default."""
        first = self._next_id("model_config", CONFIG_SCHEMA)
        as_json = lambda v: None if v is None else json.dumps(v, default=str)
        rows = [
            (first + i, c["model_name"], c["config_name"], as_json(c["parameters"]), as_json(c["preprocessing_steps"]),
             as_json(c.get("feature_engineering")), c.get("is_active", 1))
            for i, c in enumerate(configs)
        ]
        columns = (
            "id bigint, model_name string, config_name string, parameters string, preprocessing_steps string, "
            "feature_engineering string, is_active int"
        )
        self._append(rows, columns, "created_at", CONFIG_SCHEMA, "model_config")

    def results_history(self, model_name: str | None = None) -> DataFrame:
        """All stored results, newest first, of one model if named."""
        df = self._read("model_results", RESULTS_SCHEMA)
        df = df.where(F.col("model_name") == model_name) if model_name else df
        return df.orderBy(F.desc("created_at"), F.desc("id"))

    def configs(self) -> DataFrame:
        return self._read("model_config", CONFIG_SCHEMA).orderBy("id")
