"""Named queries over the driver tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasador.functions import numeric, text
from tasador.operators import clean, encode, evaluate, features, models, profile, reports, sample, scoring
from tasador.plans import analysis, ingest
from tasador.plans.oracle import bins, money, title, with_clean, with_lines, with_listings
from tasador.session import durable, scratch_path
from tasador.sources import listing_files
from tasador.sources.driver_tables import COUNTRIES, listings, table
from tasador.sources.listing_store import ListingStore, duplicate_keys

Query = Callable[[SparkSession, str], DataFrame]

RULES = clean.CleaningRules(countries=COUNTRIES)
MODEL_COLUMNS = (
    "id", "operation_type", "property_type", "province", "department",
    "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms", "price_usd",
)
TARGET = "price_usd"
SAMPLE = 1000

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def rounded(name: str, digits: int, source: str | None = None) -> Column:
    return F.round(F.col(source or name), digits).alias(name)


def by_country(spark, folder):
    return clean.keep_countries(listings(spark, folder), COUNTRIES)


def by_operation(spark, folder):
    return clean.keep_operations(by_country(spark, folder))


def present(spark, folder):
    return clean.drop_missing(clean.name_price(by_operation(spark, folder)))


def cleaned(spark, folder):
    return clean.clean_listings(listings(spark, folder), RULES)


def featured(spark, folder):
    return ingest.process(listings(spark, folder), RULES)


def stored(spark, folder):
    """Processed listings with the model columns, written once and read many times as a real run does."""
    return durable(featured(spark, folder).select(*MODEL_COLUMNS), "stored")


def one_feature(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["surface_total"], outputCol="features").transform(df)


def line_models() -> dict:
    return {
        "Linear Regression": models.linear(TARGET), "Ridge": models.Ridge(alpha=models.RIDGE_ALPHA, labelCol=TARGET),
        "Lasso": models.lasso(TARGET),
    }


def scored_lines(spark, folder, names=("Linear Regression", "Ridge", "Lasso")) -> DataFrame:
    """Test rows predicted by one-feature models."""
    train, test = sample.train_test(one_feature(stored(spark, folder)))
    parts = [
        models_.fit(train).transform(test).select(F.lit(n).alias("model"), "id", TARGET, "prediction")
        for n, models_ in line_models().items() if n in names
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def line_folds(spark, folder) -> DataFrame:
    """Fold figures of one-feature models, by the fold loop with its whole preprocessing."""
    train, _ = sample.train_test(stored(spark, folder).select("id", "surface_total", TARGET))
    chosen = {n: m for n, m in line_models().items() if n != "Lasso"}
    return evaluate.cross_validate(train, chosen, TARGET, parallelism=sample.FOLDS)


# --- sources and sinks -------------------------------------------------------------------------


def csv_copy(spark, folder, df: DataFrame | None = None) -> str:
    """The listings as CSV files, one per writing task."""
    path = scratch_path(spark, "listings_csv")
    reports.write_csv(listings(spark, folder) if df is None else df, path, single=False)
    return path


@query("csv_scan", with_listings("""
SELECT CAST(id AS VARCHAR) AS id, CAST(id AS VARCHAR) AS property_id, l1, l2, l3, operation_type, property_type,
       surface_total, surface_covered, CAST(rooms AS DOUBLE) AS rooms, CAST(bedrooms AS DOUBLE) AS bedrooms,
       CAST(bathrooms AS DOUBLE) AS bathrooms, price FROM listings"""))
def csv_scan(spark, folder):
    return listing_files.load_listings(spark, csv_copy(spark, folder))


@query("csv_probe", with_listings("SELECT least(count(*), 1000) AS n_rows, 13 AS n_columns FROM listings"))
def csv_probe(spark, folder):
    return profile.shape(listing_files.probe(spark, csv_copy(spark, folder)))


@query("csv_inferred_types", """
WITH priced AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem)
SELECT 'bigint' AS order_type, 'bigint' AS line_type, 'double' AS value_type, 'string' AS flag_type,
       count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS order_sum FROM priced""")
def csv_inferred_types(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    df = listing_files.load_listings(spark, csv_copy(spark, folder, lines), infer=True)
    kinds = dict(df.dtypes)
    names = {"order_type": "l_orderkey", "line_type": "l_linenumber", "value_type": "l_extendedprice", "flag_type": "l_returnflag"}
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("order_sum")).select(
        *[F.lit(kinds[c]).alias(n) for n, c in names.items()], "n", "order_sum"
    )


@query("key_from_id", with_listings("SELECT id, CAST(id AS VARCHAR) AS property_id FROM listings"))
def key_from_id(spark, folder):
    return listing_files.add_property_id(listings(spark, folder)).select("id", "property_id")


@query("key_from_row_position", """
SELECT CAST(row_number() OVER () - 1 AS VARCHAR) AS property_id, l_orderkey, l_linenumber, l_extendedprice FROM lineitem""")
def key_from_row_position(spark, folder):
    return listing_files.add_property_id(table(spark, folder, "lineitem")).select("property_id", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("csv_differing_headers", with_listings("SELECT CAST(id AS VARCHAR) AS id, price, surface_total, l2 FROM listings WHERE id % 2 = 0 UNION ALL SELECT CAST(id AS VARCHAR), price, surface_total, NULL FROM listings WHERE id % 2 = 1"))
def csv_differing_headers(spark, folder):
    """Files of one folder whose columns come in another order, one without a column."""
    path, df = scratch_path(spark, "differing"), listings(spark, folder)
    even = F.col("id") % 2 == 0
    for part in (df.where(even).select("id", "price", "surface_total", "l2"), df.where(~even).select("surface_total", "price", "id")):
        part.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return listing_files.load_listings(spark, path).select("id", "price", "surface_total", "l2")


@query("csv_probe_line_breaks", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name || chr(10) || n_name AS note FROM nation")
def csv_probe_line_breaks(spark, folder):
    """A probe reads quoted line breaks as a load does."""
    nations = table(spark, folder, "nation").select("n_nationkey", F.concat("n_name", F.lit("\n"), "n_name").alias("note"))
    return listing_files.probe(spark, csv_copy(spark, folder, nations)).select("n_nationkey", "note")


NOTE_SQL = """o_orderpriority || chr(10) || '"' || o_orderstatus || '",' || chr(10) || o_orderkey AS note"""


def noted_orders(spark, folder) -> DataFrame:
    """Orders with a text of three lines, quotes and commas."""
    note = F.concat("o_orderpriority", F.lit("\n\""), "o_orderstatus", F.lit("\",\n"), F.col("o_orderkey").cast("string"))
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("l1"), "o_totalprice", note.alias("note"))


@query("csv_split_line_breaks", f"SELECT CAST(o_orderkey AS VARCHAR) AS l1, round(o_totalprice, 2) AS o_totalprice, {NOTE_SQL} FROM orders")
def csv_split_line_breaks(spark, folder):
    """Every row holds line breaks in quotes, and the files are read by many tasks all the same."""
    rows = listing_files.load_listings(spark, csv_copy(spark, folder, noted_orders(spark, folder)))
    return rows.select("l1", F.round(F.col("o_totalprice").cast("double"), 2).alias("o_totalprice"), "note")


@query("csv_probe_first_rows", f"""
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR) AS property_id, CAST(o_orderkey AS VARCHAR) AS l1, {NOTE_SQL} FROM orders ORDER BY o_orderkey LIMIT 1000""")
def csv_probe_first_rows(spark, folder):
    """A probe of ordered files gives their first rows, and reads no more than these."""
    ordered = noted_orders(spark, folder).orderBy(F.col("l1").cast("long"))
    return listing_files.probe(spark, csv_copy(spark, folder, ordered)).select("property_id", "l1", "note")


@query("csv_folder", with_listings(f"""
SELECT l1, count(*) AS n, round({money('price')}, 2) AS mean_price FROM listings GROUP BY l1"""))
def csv_folder(spark, folder):
    df = listing_files.load_listings(spark, csv_copy(spark, folder), multiline=False)
    mean = F.sum(F.col("price").cast("decimal(18,2)")).cast("double") / F.count("price")
    return df.groupBy("l1").agg(F.count(F.lit(1)).alias("n"), F.round(mean, 2).alias("mean_price"))


STORED_SQL = """
SELECT CAST(id AS VARCHAR) AS property_id, property_type, operation_type, province, department, surface_total, surface_covered,
       CAST(rooms AS INTEGER) AS rooms, CAST(bedrooms AS INTEGER) AS bedrooms, CAST(bathrooms AS INTEGER) AS bathrooms, price_usd FROM stored"""


def store_all(spark, folder) -> ListingStore:
    store = ListingStore(spark, scratch_path(spark, "store"))
    store.store_listings(listing_files.add_property_id(featured(spark, folder)))
    return store


@query("store_and_read_listings", with_clean(STORED_SQL))
def store_and_read_listings(spark, folder):
    return store_all(spark, folder).read_listings().drop("id", "created_at", "raw_data")


@query("tables_made_again", with_clean("SELECT count(*) AS n, round(avg(price_usd), 2) AS mean_price FROM stored"))
def tables_made_again(spark, folder):
    """Making the tables where they are leaves what is in them."""
    again = ListingStore(spark, store_all(spark, folder).root)
    return again.read_listings().agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price_usd"), 2).alias("mean_price"))


@query("read_listings_limit", with_clean(STORED_SQL + " ORDER BY property_id LIMIT 100"))
def read_listings_limit(spark, folder):
    return store_all(spark, folder).read_listings(limit=100, order_by="property_id").drop("id", "created_at", "raw_data")


@query("safe_casts", with_listings("""
SELECT id, coalesce(l3, '') AS department, CAST(trunc(price) AS INTEGER) AS whole_price, bedrooms,
       CAST(NULL AS INTEGER) AS text_as_number, CASE WHEN id % 2 = 0 THEN -1.0 ELSE coalesce(price, -1.0) END AS price_or_default FROM listings"""))
def safe_casts(spark, folder):
    return listings(spark, folder).select(
        "id", text.safe_cast(F.col("l3"), "string", "").alias("department"),
        text.safe_cast(F.col("price"), "int").alias("whole_price"), text.safe_cast(F.col("bedrooms"), "bigint").alias("bedrooms"),
        text.safe_cast(F.col("property_type"), "int").alias("text_as_number"),
        text.safe_cast(F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("price")), "double", -1.0).alias("price_or_default"),
    )


@query("row_json", with_listings("""
SELECT id, 12 AS n_fields, l3, price, bedrooms FROM listings"""))
def row_json(spark, folder):
    df = listings(spark, folder)
    document = df.select("id", text.row_json(df).alias("raw_data"))
    parts = F.from_json("raw_data", "l3 string, price double, bedrooms bigint")
    return document.select("id", F.size(F.json_object_keys("raw_data")).alias("n_fields"), parts.alias("p")).select("id", "n_fields", "p.*")


def line_registry(spark, folder) -> list[dict]:
    scores = {r["model"]: r for r in evaluate.metrics(scored_lines(spark, folder), TARGET, "prediction", ["model"]).collect()}
    chosen = line_models()
    return [
        {"model_name": n, "model_version": "1.0", "metrics": {f"test_{m}": scores[n][m] for m in ("rmse", "mae", "r2")},
         "hyperparameters": models.hyperparameters(chosen[n])}
        for n in chosen
    ]


TEST_METRICS = """
SELECT model AS model_name, round(sqrt(avg((price_usd - prediction) ** 2)), 3) AS test_rmse,
       round(avg(abs(price_usd - prediction)), 3) AS test_mae,
       round(1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)), 6) AS test_r2, CAST(NULL AS DOUBLE) AS cv_r2_mean
FROM scored"""


@query("results_history", with_lines(TEST_METRICS + " GROUP BY model"))
def results_history(spark, folder):
    store = ListingStore(spark, scratch_path(spark, "store"))
    store.store_results(line_registry(spark, folder))
    return store.results_history().select(
        "model_name", rounded("test_rmse", 3), rounded("test_mae", 3), rounded("test_r2", 6), "cv_r2_mean"
    )


@query("results_history_of_model", with_lines(TEST_METRICS + " WHERE model = 'Ridge' GROUP BY model"))
def results_history_of_model(spark, folder):
    store = ListingStore(spark, scratch_path(spark, "store"))
    store.store_results(line_registry(spark, folder))
    return store.results_history("Ridge").select(
        "model_name", rounded("test_rmse", 3), rounded("test_mae", 3), rounded("test_r2", 6), "cv_r2_mean"
    )


@query("config_history", with_clean("""
SELECT m AS model_name, 'config_v_1.0' AS config_name, a AS alpha, n AS n_train, 1 AS is_active
FROM (VALUES ('Ridge', 1.0::DOUBLE), ('Lasso', 0.1::DOUBLE)) t(m, a), (SELECT count(*) AS n FROM train)"""))
def config_history(spark, folder):
    store = ListingStore(spark, scratch_path(spark, "store"))
    train, _ = sample.train_test(stored(spark, folder))
    chosen, n_train = models.catalogue("full", TARGET), train.count()
    store.store_configs(
        [{"model_name": n, "config_name": "config_v_1.0", "parameters": {**models.hyperparameters(chosen[n]), "n_train": n_train}, "preprocessing_steps": {}}
         for n in ("Ridge", "Lasso")]
    )
    return store.configs().select(
        "model_name", "config_name", F.get_json_object("parameters", "$.alpha").cast("double").alias("alpha"),
        F.get_json_object("parameters", "$.n_train").cast("bigint").alias("n_train"), "is_active",
    )


@query("comparison_csv", with_lines("SELECT model, round(cv_r2, 6) AS cv_r2, round(cv_rmse, 3) AS cv_rmse, round(cv_mae, 3) AS cv_mae FROM cv"))
def comparison_csv(spark, folder):
    path = scratch_path(spark, "comparison")
    reports.write_csv(reports.comparison(evaluate.summarise_folds(line_folds(spark, folder))), path)
    df = listing_files.load_listings(spark, path, infer=True)
    return df.select("model", rounded("cv_r2", 6), rounded("cv_rmse", 3), rounded("cv_mae", 3))


STRATA = f"""
edges AS (SELECT unnest(quantile_cont(price_usd, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM stored),
placed AS (SELECT s.id, s.price_usd, 1 + count(e) AS stratum FROM stored s LEFT JOIN edges ON s.price_usd > e GROUP BY s.id, s.price_usd),
strata AS (SELECT stratum, count(*) AS n FROM placed GROUP BY stratum),
passed AS (SELECT stratum, sum(n) OVER (ORDER BY stratum) AS upto, n, sum(n) OVER () AS total FROM strata),
shares AS (SELECT stratum, upto * {SAMPLE} // total - (upto - n) * {SAMPLE} // total AS share FROM passed),
ranked AS (SELECT p.*, row_number() OVER (PARTITION BY stratum ORDER BY md5(id::VARCHAR || '|42'), id) AS rk FROM placed p),
chosen AS (SELECT id, price_usd FROM ranked JOIN shares USING (stratum) WHERE rk <= share OR (SELECT max(total) FROM passed) <= {SAMPLE})"""


@query("sample_csv", with_clean("SELECT CAST(id AS VARCHAR) AS id, price_usd FROM chosen", STRATA))
def sample_csv(spark, folder):
    path, rows = scratch_path(spark, "sample"), stored(spark, folder)
    ingest.save_sample(rows, path, SAMPLE, identity="id")
    return listing_files.load_listings(spark, path).select(F.col("id").cast("string").alias("id"), TARGET)


@query("exploration_document", with_clean("""
SELECT count(*) AS n_rows, 11 AS n_columns, count(*) - count(bedrooms) AS missing_bedrooms, count(price_usd) AS n_prices,
       round(avg(price_usd), 2) AS mean_price, round(median(price_usd), 2) AS median_price FROM stored"""))
def exploration_document(spark, folder):
    path = scratch_path(spark, "exploration")
    reports.write_document(spark, reports.exploration_document(stored(spark, folder)), path)
    document = spark.read.text(path, wholetext=True)
    part = lambda p, kind: F.get_json_object("value", f"$.{p}").cast(kind)
    return document.select(
        part("shape[0]", "bigint").alias("n_rows"), part("shape[1]", "int").alias("n_columns"),
        part("missing_values.bedrooms", "bigint").alias("missing_bedrooms"), part("target_stats.count", "bigint").alias("n_prices"),
        F.round(part("target_stats.mean", "double"), 2).alias("mean_price"), F.round(part("target_stats.q50", "double"), 2).alias("median_price"),
    )


@query("report_table", with_lines("""
SELECT '| ' || model || ' | ' || printf('%.4f', cv_r2) || ' | ' || printf('%.0f', cv_rmse) || ' | ' || printf('%.0f', cv_mae) || ' |' AS line FROM cv"""))
def report_table(spark, folder):
    path, rows = scratch_path(spark, "report"), line_folds(spark, folder)
    table_ = reports.comparison(evaluate.summarise_folds(rows))
    reports.write_lines(reports.report_lines(table_, "cv_r2", "cv_rmse", "cv_mae", stored(spark, folder).count()), path)
    return spark.read.text(path).select(F.col("value").alias("line")).where(F.col("line").rlike(r"^\| [A-Z]"))


@query("saved_model_scores", with_lines("SELECT model, id, round(prediction, 2) AS predicted_price FROM scored WHERE model <> 'Lasso'"))
def saved_model_scores(spark, folder):
    """Models saved below one folder, found and loaded again, score the test listings in raw spelling."""
    root, rows = scratch_path(spark, "models"), stored(spark, folder)
    train, test = sample.train_test(rows)
    assemble = VectorAssembler(inputCols=["surface_total"], outputCol="features")
    for name in ("Linear Regression", "Ridge"):
        scoring.save_model(Pipeline(stages=[assemble, line_models()[name]]).fit(train), root, name)
    raw = test.drop(TARGET).withColumn("property_type", F.concat(F.lit(" "), F.upper("property_type")))
    parts = [
        scoring.score(model, raw).select(F.lit(name).alias("model"), "id", rounded("predicted_price", 2))
        for name, model in scoring.load_models(spark, root).items()
    ]
    return parts[0].unionByName(parts[1])


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"))


# --- filters and projections -------------------------------------------------------------------

RAW = "id, l1, l2, l3, operation_type, property_type, surface_total, surface_covered, rooms, bedrooms, bathrooms"

query("country_filter", with_clean(f"SELECT {RAW}, price FROM by_country"))(by_country)
query("operation_filter", with_clean(f"SELECT {RAW}, price FROM by_operation"))(by_operation)
query("critical_values_filter", with_clean(f"SELECT {RAW}, price_usd FROM present"))(present)


@query("price_name", with_clean(f"SELECT {RAW}, price_usd FROM priced"))
def price_name(spark, folder):
    return clean.name_price(by_operation(spark, folder))


@query("price_outlier_filter", with_clean(f"SELECT {RAW}, price_usd FROM in_iqr"))
def price_outlier_filter(spark, folder):
    return clean.drop_price_outliers(present(spark, folder))


@query("event_outlier_filter", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, user_id, event_type, value FROM events, q WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def event_outlier_filter(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return clean.drop_price_outliers(events, "value")


@query("surface_filter", with_clean(f"SELECT {RAW}, price_usd FROM present WHERE surface_total > 0 AND surface_total < 2000"))
def surface_filter(spark, folder):
    return clean.keep_surfaces(present(spark, folder))


@query("target_filter", with_listings("SELECT id, price AS price_usd FROM listings WHERE price IS NOT NULL"))
def target_filter(spark, folder):
    return analysis.model_rows(clean.name_price(listings(spark, folder))).select("id", TARGET)


@query("dropped_columns", with_listings("SELECT id, l1, l2, l3, operation_type, property_type, rooms, bedrooms, bathrooms FROM listings"))
def dropped_columns(spark, folder):
    return clean.drop_columns(listings(spark, folder), ("price", "surface_total", "surface_covered", "absent"))


@query("numeric_columns", with_listings("SELECT surface_total, surface_covered, rooms, bedrooms, bathrooms, price FROM listings"))
def numeric_columns(spark, folder):
    df = listings(spark, folder)
    return df.select(*numeric.numeric_columns(df, ("id",)))


@query("text_columns", with_listings("SELECT l1, l2, l3, operation_type, property_type FROM listings"))
def text_columns(spark, folder):
    df = listings(spark, folder)
    return df.select(*numeric.text_columns(df))


@query("departments_of_province", with_clean("SELECT DISTINCT department FROM featured WHERE province = (SELECT min(province) FROM featured)"))
def departments_of_province(spark, folder):
    df = featured(spark, folder)
    return profile.departments_of(df, df.agg(F.min("province")).first()[0])


@query("plot_trim", with_clean("""
SELECT s.id, surface_total, price_usd FROM stored s, (SELECT quantile_cont(surface_total, 0.99) AS a, quantile_cont(price_usd, 0.99) AS b FROM stored)
WHERE surface_total < a AND price_usd < b"""))
def plot_trim(spark, folder):
    return profile.trim_plot(stored(spark, folder)).select("id", "surface_total", TARGET)


@query("comparison_columns", with_lines("SELECT model, round(cv_r2, 6) AS cv_r2, round(cv_rmse, 3) AS cv_rmse, round(cv_mae, 3) AS cv_mae FROM cv ORDER BY cv_r2 DESC"))
def comparison_columns(spark, folder):
    df = reports.comparison(evaluate.summarise_folds(line_folds(spark, folder)))
    return df.select("model", rounded("cv_r2", 6), rounded("cv_rmse", 3), rounded("cv_mae", 3))


query("clean_listings", with_clean(f"SELECT {RAW}, price_usd FROM clean"))(cleaned)


# --- scalar functions --------------------------------------------------------------------------


@query("normalised_texts", with_listings(f"""
SELECT id, {title('l2')} AS l2, {title('l3')} AS l3, {title('operation_type')} AS operation_type, {title('property_type')} AS property_type FROM listings"""))
def normalised_texts(spark, folder):
    return clean.normalise_columns(listings(spark, folder)).select("id", "l2", "l3", "operation_type", "property_type")


@query("normalised_part_names", f"SELECT p_partkey, {title('p_name')} AS p_name, {title('p_type')} AS p_type FROM part")
def normalised_part_names(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    return clean.normalise_columns(part, ("p_name", "p_type"))


@query("surface_ratio", with_clean("SELECT id, surface_ratio FROM featured"))
def surface_ratio(spark, folder):
    return features.add_surface_ratio(cleaned(spark, folder)).select("id", "surface_ratio")


@query("total_rooms", with_clean("SELECT id, total_rooms FROM featured"))
def total_rooms(spark, folder):
    return features.add_total_rooms(cleaned(spark, folder)).select("id", "total_rooms")


@query("room_density", with_clean("SELECT id, room_density FROM featured"))
def room_density(spark, folder):
    return features.add_room_density(cleaned(spark, folder)).select("id", "room_density")


@query("location_columns", with_clean("SELECT id, province, department FROM featured"))
def location_columns(spark, folder):
    return features.add_location(cleaned(spark, folder)).select("id", "province", "department")


@query("surface_category", with_clean("""
SELECT id, surface_bin, ['Muy Pequeña', 'Pequeña', 'Mediana', 'Grande', 'Muy Grande'][surface_bin] AS surface_category FROM featured"""))
def surface_category(spark, folder):
    return featured(spark, folder).select("id", "surface_bin", "surface_category")


@query("log_price", with_clean("SELECT id, round(ln(1 + price_usd), 9) AS log_price FROM stored"))
def log_price(spark, folder):
    return cleaned(spark, folder).select("id", F.round(numeric.log_price(F.col(TARGET)), 9).alias("log_price"))


@query("number_formats", with_clean("""
SELECT id, format('{:,.2f}', price_usd) AS grouped_2, printf('%.4f', surface_ratio) AS fixed_4 FROM featured"""))
def number_formats(spark, folder):
    return featured(spark, folder).select(
        "id", text.grouped(F.col(TARGET), 2).alias("grouped_2"), text.fixed(F.col("surface_ratio"), 4).alias("fixed_4")
    )


# Importance stand-in with exact values: the mean price of a category, under its one-hot name.
NAMED_SQL = f"""
named AS (SELECT 'cat_low__property_type_' || property_type AS feature, {money()} AS importance FROM stored GROUP BY property_type
          UNION ALL SELECT 'cat_low__operation_type_' || operation_type, {money()} FROM stored GROUP BY operation_type
          UNION ALL SELECT 'cat_high__department_' || department, {money()} FROM stored GROUP BY department),
short AS (SELECT list_last(string_split(feature, '__')) AS feature, importance FROM named),
grouped AS (SELECT string_split(feature, '_')[1] AS feature_group, sum(importance) AS importance FROM short GROUP BY 1)"""


def named_importance(spark, folder) -> DataFrame:
    df, parts = stored(spark, folder), []
    mean = F.sum(F.col(TARGET).cast("decimal(18,2)")).cast("double") / F.count(TARGET)
    for prefix, column in (("cat_low__", "property_type"), ("cat_low__", "operation_type"), ("cat_high__", "department")):
        parts.append(df.groupBy(F.concat(F.lit(f"{prefix}{column}_"), F.col(column)).alias("feature")).agg(mean.alias("importance")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def short_importance(spark, folder) -> DataFrame:
    return named_importance(spark, folder).withColumn("feature", text.clean_feature_name(F.col("feature")))


@query("feature_name_parts", with_clean("""
SELECT n.feature, list_last(string_split(n.feature, '__')) AS short_name, string_split(list_last(string_split(n.feature, '__')), '_')[1] AS feature_group FROM named n""", NAMED_SQL))
def feature_name_parts(spark, folder):
    name = F.col("feature")
    return named_importance(spark, folder).select(
        "feature", text.clean_feature_name(name).alias("short_name"), text.feature_group(name).alias("feature_group")
    )


@query("quality_labels", with_lines("""
SELECT model, fold, round(r2, 6) AS r2, CASE WHEN r2 > 0.8 THEN 'excelente' WHEN r2 > 0.6 THEN 'buena' ELSE 'moderada' END AS quality FROM fold_metrics"""))
def quality_labels(spark, folder):
    return reports.with_quality(line_folds(spark, folder), "r2").select("model", "fold", rounded("r2", 6), "quality")


@query("residuals", with_lines("SELECT model, id, round(price_usd - prediction, 2) AS residual FROM scored"))
def residuals(spark, folder):
    return scored_lines(spark, folder).select("model", "id", F.round(evaluate.residual(TARGET, "prediction"), 2).alias("residual"))


# --- aggregations and profiling ----------------------------------------------------------------


@query("price_description", with_clean("""
SELECT count(price_usd) AS count, round(avg(price_usd), 2) AS mean, round(stddev_samp(price_usd), 2) AS std, min(price_usd) AS min,
       round(quantile_cont(price_usd, 0.25), 4) AS q25, round(quantile_cont(price_usd, 0.5), 4) AS q50, round(quantile_cont(price_usd, 0.75), 4) AS q75,
       max(price_usd) AS max FROM stored"""))
def price_description(spark, folder):
    df = profile.describe(stored(spark, folder))
    return df.select("count", rounded("mean", 2), rounded("std", 2), "min", rounded("q25", 4), rounded("q50", 4), rounded("q75", 4), "max")


@query("missing_counts", with_listings("""
SELECT unnest(['id', 'l1', 'l2', 'l3', 'operation_type', 'property_type', 'surface_total', 'surface_covered', 'rooms', 'bedrooms', 'bathrooms', 'price']) AS "column",
       unnest([0, 0, 0, count(*) - count(l3), 0, 0, count(*) - count(surface_total), count(*) - count(surface_covered), count(*) - count(rooms),
               count(*) - count(bedrooms), count(*) - count(bathrooms), count(*) - count(price)]) AS n_missing,
       count(*) AS n_rows FROM listings"""))
def missing_counts(spark, folder):
    return profile.null_counts(listings(spark, folder))


@query("missing_percent", with_clean("""
SELECT * FROM (SELECT unnest(['surface_covered', 'bedrooms']) AS "column",
       unnest([(count(*) - count(surface_covered)) * 100.0 / count(*), (count(*) - count(bedrooms)) * 100.0 / count(*)]) AS percent,
       unnest([(count(*) - count(surface_covered)) * 100.0 / count(*) > 20, (count(*) - count(bedrooms)) * 100.0 / count(*) > 20]) AS above_alarm
FROM stored) WHERE percent > 0"""))
def missing_percent(spark, folder):
    return profile.null_percent(stored(spark, folder))


HISTOGRAM = "SELECT bin, low, high, n FROM histogram"


def histogram_rows(df: DataFrame) -> DataFrame:
    return df.select("bin", rounded("low", 6), rounded("high", 6), "n")


@query("price_histogram", with_clean(HISTOGRAM, bins("stored", "price_usd", 50)))
def price_histogram(spark, folder):
    return histogram_rows(profile.histogram(stored(spark, folder), TARGET))


@query("log_price_histogram", with_clean(HISTOGRAM, "logged AS (SELECT ln(1 + price_usd) AS v FROM stored)", bins("logged", "v", 50)))
def log_price_histogram(spark, folder):
    return histogram_rows(profile.histogram(stored(spark, folder), numeric.log_price(F.col(TARGET))))


def density_sql(source: str, value: str) -> str:
    return f"""
f AS (SELECT count(*) AS n, stddev_samp({value}) * power(count(*), -0.2) AS h, min({value}) AS lo, max({value}) AS hi FROM {source}),
d AS (SELECT CAST(p AS INTEGER) AS point, lo + p * (hi - lo) / 199 AS x, n, h FROM range(200) t(p), f),
curve AS (SELECT point, x, sum(exp(-0.5 * power(({value} - x) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density FROM d, {source} GROUP BY point, x)"""


@query("price_density", with_clean("SELECT point, round(x, 4) AS x, round(density * 1e6, 8) AS density_millionth FROM curve", density_sql("stored", "price_usd")))
def price_density(spark, folder):
    df = profile.density(stored(spark, folder), TARGET)
    return df.select("point", rounded("x", 4), F.round(F.col("density") * 1e6, 8).alias("density_millionth"))


@query("log_price_density", with_clean("SELECT point, round(x, 9) AS x, round(density, 9) AS density FROM curve",
                                       "logged AS (SELECT ln(1 + price_usd) AS v FROM stored)", density_sql("logged", "v")))
def log_price_density(spark, folder):
    df = profile.density(stored(spark, folder), numeric.log_price(F.col(TARGET)))
    return df.select("point", rounded("x", 9), rounded("density", 9))


NUMBERS = ("surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms", "price_usd")


@query("correlations", with_clean(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM stored" for a in NUMBERS for b in NUMBERS)))
def correlations(spark, folder):
    return profile.correlations(stored(spark, folder)).select("a", "b", rounded("r", 6))


@query("dataset_shape", with_listings("SELECT count(*) AS n_rows, 12 AS n_columns FROM listings"))
def dataset_shape(spark, folder):
    return profile.shape(listings(spark, folder))


@query("column_types", """
SELECT CAST(row_number() OVER (ORDER BY column_index) - 1 AS INTEGER) AS position, column_name AS name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS type,
       CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' WHEN data_type = 'VARCHAR' THEN 'text' ELSE 'other' END AS class
FROM duckdb_columns() WHERE table_name = 'lineitem'""")
def column_types(spark, folder):
    return profile.column_types(table(spark, folder, "lineitem")).drop("nullable").withColumn(
        "type", F.when(F.col("type") == "timestamp_ntz", "timestamp").otherwise(F.col("type"))
    )


@query("price_statistics", with_clean("""
SELECT min(price_usd) AS min, max(price_usd) AS max, round(avg(price_usd), 2) AS mean, round(median(price_usd), 4) AS median FROM stored"""))
def price_statistics(spark, folder):
    return profile.price_statistics(stored(spark, folder)).select("min", "max", rounded("mean", 2), rounded("median", 4))


@query("importance_groups", with_clean("SELECT feature_group, round(importance, 2) AS importance FROM grouped", NAMED_SQL))
def importance_groups(spark, folder):
    return reports.group_importance(short_importance(spark, folder)).select("feature_group", rounded("importance", 2))


@query("locations", with_clean("SELECT DISTINCT province, department FROM stored ORDER BY province, department"))
def locations(spark, folder):
    return profile.locations(featured(spark, folder))


@query("provinces", with_clean("SELECT DISTINCT province FROM stored"))
def provinces(spark, folder):
    return profile.provinces(featured(spark, folder))


@query("residual_histogram", with_lines(HISTOGRAM, "res AS (SELECT price_usd - prediction AS v FROM scored WHERE model = 'Linear Regression')",
                                        bins("res", "v", 30).replace(", 6)", ", 3)")))
def residual_histogram(spark, folder):
    df = profile.residual_histogram(scored_lines(spark, folder, ("Linear Regression",)), TARGET, "prediction")
    return df.select("bin", rounded("low", 3), rounded("high", 3), "n")


def group_sql(keys: str) -> str:
    return f"""
SELECT {keys}, count(*) AS n, round(count(*) / (SELECT count(*) FROM stored), 9) AS share, round({money()}, 2) AS mean_price,
       round(median(price_usd), 3) AS median_price FROM stored GROUP BY {keys}"""


def price_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    grouped = profile.price_by(df, keys)
    return grouped.select(*keys, "n", rounded("share", 9), rounded("mean_price", 2), rounded("median_price", 3))


@query("price_by_location", with_clean(group_sql("province, department")))
def price_by_location(spark, folder):
    return price_groups(featured(spark, folder), ["province", "department"])


@query("price_by_property_type", with_clean(group_sql("property_type")))
def price_by_property_type(spark, folder):
    return price_groups(featured(spark, folder), ["property_type"])


@query("dataset_info", "SELECT count(*) AS total_rows, 1 AS n_files FROM lineitem")
def dataset_info(spark, folder):
    return listing_files.dataset_info(table(spark, folder, "lineitem")).select("total_rows", "n_files")


# --- order, limits, samples, splits ------------------------------------------------------------


@query("model_ranking", with_lines("SELECT model, CAST(row_number() OVER (ORDER BY cv_r2 DESC, model) AS INTEGER) AS place, round(cv_r2, 6) AS cv_r2 FROM cv"))
def model_ranking(spark, folder):
    table_ = reports.comparison(evaluate.summarise_folds(line_folds(spark, folder)))
    place = F.row_number().over(Window.orderBy(F.desc("cv_r2"), "model"))  # a row for each model
    return table_.select("model", place.alias("place"), rounded("cv_r2", 6))


@query("test_comparison", with_lines("""
SELECT model, round(sqrt(avg((price_usd - prediction) ** 2)), 3) AS rmse,
       round(1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)), 6) AS r2 FROM scored GROUP BY model"""))
def test_comparison(spark, folder):
    df = evaluate.metrics(scored_lines(spark, folder), TARGET, "prediction", ["model"])
    return reports.test_comparison(df).select("model", rounded("rmse", 3), rounded("r2", 6))


@query("top_feature_groups", with_clean("SELECT feature_group, round(importance, 2) AS importance FROM grouped ORDER BY grouped.importance DESC, feature_group LIMIT 20", NAMED_SQL))
def top_feature_groups(spark, folder):
    return reports.top_groups(short_importance(spark, folder)).select("feature_group", rounded("importance", 2))


@query("top_features", with_clean("SELECT feature, round(importance, 2) AS importance FROM short ORDER BY short.importance DESC, feature LIMIT 15", NAMED_SQL))
def top_features(spark, folder):
    return reports.top_features(short_importance(spark, folder)).select("feature", rounded("importance", 2))


@query("best_model", with_lines("SELECT model, round(cv_r2, 6) AS cv_r2 FROM cv ORDER BY cv.cv_r2 DESC, model LIMIT 1"))
def best_model(spark, folder):
    table_ = reports.comparison(evaluate.summarise_folds(line_folds(spark, folder)))
    return reports.best_model(table_, "cv_r2").select("model", rounded("cv_r2", 6))


@query("first_rows", with_listings("SELECT * FROM listings ORDER BY id LIMIT 5"))
def first_rows(spark, folder):
    return profile.first_rows(listings(spark, folder), "id")


@query("random_sample", with_clean("SELECT id, price_usd FROM stored ORDER BY md5(id::VARCHAR || '|42'), id LIMIT 2000"))
def random_sample(spark, folder):
    return sample.random_sample(featured(spark, folder)).select("id", TARGET)


@query("stratified_sample", with_clean("SELECT id, price_usd FROM chosen", STRATA))
def stratified_sample(spark, folder):
    return sample.stratified_sample(stored(spark, folder), SAMPLE).select("id", TARGET)


@query("train_test_split", with_clean("SELECT id, u < 858993459 AS is_test FROM stored"))
def train_test_split(spark, folder):
    return featured(spark, folder).select("id", sample.is_test(F.col("id")).alias("is_test"))


@query("folds", with_clean("SELECT id, fold FROM stored"))
def folds(spark, folder):
    return sample.add_fold(featured(spark, folder)).select("id", "fold")


# --- preprocessing -----------------------------------------------------------------------------

INPUTS = ("surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms")
IMPUTED_SQL = "\n".join((
    "meds AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in INPUTS) + " FROM train),",
    "filled AS (SELECT id, u, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in INPUTS) + " FROM stored, meds),",
    "scales AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in INPUTS) + " FROM filled WHERE u >= 858993459)",
))


@query("median_imputation", with_clean("SELECT id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in INPUTS) + " FROM filled", IMPUTED_SQL))
def median_imputation(spark, folder):
    df = stored(spark, folder)
    medians = encode.fit_medians(sample.train_test(df)[0], INPUTS)
    return df.select("id", *[encode.imputed(c, m).alias(c) for c, m in medians.items()])


@query("standardisation", with_clean("SELECT id, " + ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS num__{c}" for c in INPUTS) + " FROM filled, scales", IMPUTED_SQL))
def standardisation(spark, folder):
    df = stored(spark, folder)
    block = encode.NumericBlock(inputCols=list(INPUTS), outputCols=[f"num__{c}" for c in INPUTS]).fit(sample.train_test(df)[0])
    return block.transform(df).select("id", *[rounded(f"num__{c}", 6) for c in INPUTS])


@query("mode_imputation", with_listings("""
SELECT id, coalesce(l3, (SELECT m.l3 FROM listings m WHERE m.l3 IS NOT NULL GROUP BY m.l3 ORDER BY count(*) DESC, m.l3 LIMIT 1)) AS l3,
       operation_type FROM listings"""))
def mode_imputation(spark, folder):
    df = listings(spark, folder)
    block = encode.ModeImputer(inputCols=["l3", "operation_type"], outputCols=["l3", "operation_type"]).fit(df)
    return block.transform(df).select("id", "l3", "operation_type")


def long_vectors(encoded: DataFrame, digits: int = 6) -> DataFrame:
    """One row per listing and non-zero feature, with the feature's name."""
    names = F.array(*[F.lit(n) for n in encode.feature_names(encoded)])
    values = F.filter(F.transform(vector_to_array("features"), lambda v, i: F.struct(i.alias("index"), v.alias("value"))), lambda p: p.value != 0)
    pairs = encoded.select("id", F.inline(values))
    return pairs.select("id", F.get(names, F.col("index")).alias("feature"), F.round("value", digits).alias("value"))


@query("one_hot", with_clean("""
SELECT t.id, 'cat_low__property_type_' || property_type AS feature, 1.0::DOUBLE AS value FROM test t WHERE property_type IN (SELECT property_type FROM train WHERE operation_type = 'Venta')
UNION ALL SELECT id, 'cat_low__operation_type_' || operation_type, 1.0::DOUBLE FROM test WHERE operation_type = 'Venta'"""))
def one_hot(spark, folder):
    """Learned from sales only, so that the other operation is an unseen category."""
    train, test = sample.train_test(stored(spark, folder))
    chosen = ["property_type", "operation_type"]
    sales = train.where(F.col("operation_type") == "Venta").select("id", *chosen, TARGET)
    fitted = encode.preprocessor(sales, TARGET).fit(sales)
    return long_vectors(encode.encode(fitted, test.select("id", *chosen), ["id"]))


@query("one_hot_empty_category", with_clean("""
SELECT id, 'cat_low__operation_type_' || CASE WHEN operation_type = 'Venta' THEN '' ELSE operation_type END AS feature, 1.0::DOUBLE AS value FROM test
WHERE operation_type IN (SELECT operation_type FROM train)"""))
def one_hot_empty_category(spark, folder):
    """An empty text is a category like any other."""
    train, test = sample.train_test(stored(spark, folder))
    kind = F.when(F.col("operation_type") == "Venta", F.lit("")).otherwise(F.col("operation_type")).alias("operation_type")
    rows = train.select("id", kind, TARGET)
    return long_vectors(encode.encode(encode.preprocessor(rows, TARGET).fit(rows), test.select("id", kind), ["id"]))


@query("unknown_category", with_listings("SELECT id, coalesce(l3, 'Desconocido') AS department FROM listings"))
def unknown_category(spark, folder):
    return listings(spark, folder).select("id", encode.known_category("l3").alias("department"))


def target_sql(name: str, column: str, rows: str, inner: bool) -> str:
    """Encodings of ``column`` for the rows of ``rows``, learned from ``train``."""
    other = "AND x.inner_fold <> r.inner_fold" if inner else ""
    fold = "inner_fold" if inner else "0"
    overall = f"""
{name}_all AS (SELECT f, avg(price_usd) AS m, var_pop(price_usd) AS v FROM train, range(5) t(f) WHERE {'inner_fold <> f' if inner else 'f = 0'} GROUP BY f),
{name}_cat AS (SELECT f, {column} AS c, count(*) AS n, avg(price_usd) AS m, count(*) * var_pop(price_usd) AS ss
               FROM train, range(5) t(f) WHERE {'inner_fold <> f' if inner else 'f = 0'} GROUP BY f, {column}),
{name} AS (SELECT r.id, CASE WHEN k.n IS NULL OR a.v * k.n + k.ss / k.n = 0 THEN a.m
             ELSE a.v * k.n / (a.v * k.n + k.ss / k.n) * k.m + (1 - a.v * k.n / (a.v * k.n + k.ss / k.n)) * a.m END AS e
           FROM {rows} r JOIN {name}_all a ON a.f = r.{fold if inner else 'zero'} LEFT JOIN {name}_cat k ON k.f = a.f AND k.c = r.{column})"""
    return overall


TRAIN0, TEST0 = "(SELECT *, 0 AS zero FROM train)", "(SELECT *, 0 AS zero FROM test)"


def target_query(inner: bool) -> str:
    rows = TRAIN0 if inner else TEST0
    return with_clean(
        "SELECT p.id, round(p.e, 3) AS province, round(d.e, 3) AS department FROM enc_p p JOIN enc_d d USING (id)",
        target_sql("enc_p", "province", rows, inner), target_sql("enc_d", "department", rows, inner),
    )


def target_encoder(train: DataFrame):
    high = list(encode.HIGH_CARDINALITY)
    return encode.FoldTargetEncoder(inputCols=high, outputCols=[f"cat_high__{c}" for c in high], labelCol=TARGET).fit(
        sample.add_inner_fold(train, encode.INNER_FOLD)
    )


@query("target_encoding_of_training_rows", target_query(True))
def target_encoding_of_training_rows(spark, folder):
    train, _ = sample.train_test(stored(spark, folder))
    out = target_encoder(train).transform(sample.add_inner_fold(train, encode.INNER_FOLD))
    return out.select("id", *[rounded(c, 3, f"cat_high__{c}") for c in encode.HIGH_CARDINALITY])


@query("target_encoding_of_new_rows", target_query(False))
def target_encoding_of_new_rows(spark, folder):
    train, test = sample.train_test(stored(spark, folder))
    out = target_encoder(train).transform(test)
    return out.select("id", *[rounded(c, 3, f"cat_high__{c}") for c in encode.HIGH_CARDINALITY])


VECTOR_SQL = "\nUNION ALL ".join(
    [f"SELECT id, 'num__{c}' AS feature, round(({c} - a_{c}) / s_{c}, 3) AS value FROM filled, scales WHERE u < 858993459" for c in INPUTS]
    + [f"SELECT id, 'cat_low__{c}_' || {c}, 1.0 FROM test WHERE {c} IN (SELECT {c} FROM train)" for c in ("operation_type", "property_type")]
    + [f"SELECT id, 'cat_high__{c}', round(e, 3) FROM enc_{c[0]}" for c in ("province", "department")]
)


@query("feature_vectors", with_clean(
    f"SELECT * FROM ({VECTOR_SQL}) WHERE value <> 0", IMPUTED_SQL,
    target_sql("enc_p", "province", TEST0, False), target_sql("enc_d", "department", TEST0, False)))
def feature_vectors(spark, folder):
    """The whole preprocessing in long form: blocks, names and values of every test listing."""
    train, test = sample.train_test(stored(spark, folder))
    marked = sample.add_inner_fold(train, encode.INNER_FOLD)
    fitted = encode.preprocessor(train, TARGET).fit(marked)
    return long_vectors(encode.encode(fitted, test, ["id"]), 3).where("value != 0")


@query("feature_names", with_clean("""
SELECT feature FROM (SELECT 'num__' || unnest(['surface_total', 'surface_covered', 'rooms', 'bedrooms', 'bathrooms']) AS feature
UNION ALL SELECT DISTINCT 'cat_low__operation_type_' || operation_type FROM train
UNION ALL SELECT DISTINCT 'cat_low__property_type_' || property_type FROM train
UNION ALL SELECT unnest(['cat_high__province', 'cat_high__department']))"""))
def feature_names(spark, folder):
    train, _ = sample.train_test(stored(spark, folder))
    fitted = encode.preprocessor(train, TARGET).fit(sample.add_inner_fold(train, encode.INNER_FOLD))
    names = encode.feature_names(encode.encode(fitted, train, ["id"]))
    return spark.createDataFrame([(n,) for n in names], "feature string")


# --- models, evaluation, scoring ---------------------------------------------------------------


def fitted_line(name: str) -> Query:
    def run(spark, folder):
        train, _ = sample.train_test(one_feature(stored(spark, folder)))
        model = line_models()[name].fit(train)
        return spark.createDataFrame([(name, round(float(model.coefficients[0]), 4), round(model.intercept, 2))], "model string, slope double, intercept double")

    return run


for _name, _key in (("Linear Regression", "least_squares"), ("Ridge", "ridge"), ("Lasso", "lasso")):
    query(_key, with_lines(f"SELECT model, round(slope, 4) AS slope, round(intercept, 2) AS intercept FROM lines WHERE model = '{_name}'"))(fitted_line(_name))


@query("two_features", with_clean("""
SELECT model, round((c1 * (s22 + a) - c2 * s12) / ((s11 + a) * (s22 + a) - s12 * s12), 4) AS of_surface,
       round((c2 * (s11 + a) - c1 * s12) / ((s11 + a) * (s22 + a) - s12 * s12), 3) AS of_rooms
FROM pairs, (VALUES ('Linear Regression', 0.0::DOUBLE), ('Ridge', 1.0::DOUBLE)) t(model, a)""", """
pairs AS (SELECT count(*) * var_pop(surface_total) AS s11, count(*) * var_pop(rooms) AS s22, count(*) * covar_pop(surface_total, rooms) AS s12,
                 count(*) * covar_pop(price_usd, surface_total) AS c1, count(*) * covar_pop(price_usd, rooms) AS c2 FROM train)"""))
def two_features(spark, folder):
    """Coefficients of two correlated features, against the normal equations."""
    train, _ = sample.train_test(stored(spark, folder))
    rows = VectorAssembler(inputCols=["surface_total", "rooms"], outputCol="features").transform(train.withColumn("rooms", F.col("rooms").cast("double")))
    chosen = {n: m.fit(rows).coefficients for n, m in line_models().items() if n != "Lasso"}
    return spark.createDataFrame([(n, round(float(w[0]), 4), round(float(w[1]), 3)) for n, w in chosen.items()], "model string, of_surface double, of_rooms double")


def full_preprocessing(rows: DataFrame) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fitted preprocessing, training rows encoded for a fit, and test rows."""
    train, test = sample.train_test(rows)
    marked = sample.add_inner_fold(train, encode.INNER_FOLD)
    fitted = encode.preprocessor(train, TARGET).fit(marked)
    return fitted, encode.encode(fitted, marked, ["id", TARGET]), test


# A stump: one split of the surface at its median, predicting the mean price of either side.
STUMP_SQL = """
halves AS (SELECT median(surface_total) AS m FROM train),
sides AS (SELECT surface_total > m AS up, avg(price_usd) AS p FROM train, halves GROUP BY 1),
stumped AS (SELECT price_usd, p FROM test, halves, sides WHERE up = (surface_total > m))"""


def stump_r2(train: DataFrame, test: DataFrame) -> DataFrame:
    middle = train.agg(F.percentile("surface_total", F.lit(0.5))).first()[0]
    up = (F.col("surface_total") > middle).alias("up")
    sides = train.groupBy(up).agg(F.avg(TARGET).alias("prediction"))
    return evaluate.metrics(test.select(TARGET, up).join(F.broadcast(sides), "up"), TARGET, "prediction").select("n", rounded("stump_r2", 6, "r2"))


def fitted_trees(name: str, model) -> Query:
    """One tree model on the full preprocessing. SQL cannot grow such trees; they must predict better than a stump, which it can."""

    def run(spark, folder):
        rows = stored(spark, folder)
        fitted, fit_rows, test = full_preprocessing(rows)
        fit_rows.persist()
        try:
            trained = model().fit(fit_rows)
        finally:
            fit_rows.unpersist()
        scored = trained.transform(encode.encode(fitted, test, ["id", TARGET]))
        figures = evaluate.metrics(scored, TARGET, "prediction").select("r2")
        stump = stump_r2(sample.train_test(rows)[0], test)
        return figures.join(stump, F.col("r2") > F.col("stump_r2"), "right").select(F.lit(name).alias("model"), "n", "stump_r2", F.col("r2").isNotNull().alias("beats_stump"))

    return run


for _name, _key, _model in (
    ("Random Forest", "random_forest", models.random_forest), ("Gradient Boosting", "gradient_boosting", models.gradient_boosting),
    ("Boosted Trees", "boosted_trees", models.boosted),
):
    query(_key, with_clean(f"""
SELECT '{_name}' AS model, count(*) AS n, round(1 - sum((price_usd - p) ** 2) / (count(*) * var_pop(price_usd)), 6) AS stump_r2, TRUE AS beats_stump FROM stumped""", STUMP_SQL))(
        fitted_trees(_name, lambda make=_model: make(TARGET))
    )


def leafwise_sql(leaves: int, leaf_rows: int) -> str:
    """The leaves of one tree on rooms and bathrooms, split by split: of all cuts of all leaves the one with the largest gain."""
    steps = ["""
mean_price AS (SELECT avg(price_usd) AS m FROM train),
cells_0 AS (SELECT rooms, bathrooms, count(*) FILTER (u >= 858993459) AS n, coalesce(sum(price_usd - m) FILTER (u >= 858993459), 0) AS s, 0 AS leaf FROM stored, mean_price GROUP BY ALL),
cuts AS (SELECT DISTINCT 0 AS f, rooms AS c FROM cells_0 UNION SELECT DISTINCT 1, bathrooms FROM cells_0)"""]
    for k in range(leaves - 1):
        steps.append(f"""
sides_{k} AS (SELECT leaf, f, c, sum(n) FILTER (CASE f WHEN 0 THEN rooms ELSE bathrooms END <= c) AS nl, sum(s) FILTER (CASE f WHEN 0 THEN rooms ELSE bathrooms END <= c) AS sl, sum(n) AS n, sum(s) AS s
              FROM cells_{k}, cuts GROUP BY ALL),
gains_{k} AS (SELECT leaf, f, c, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM sides_{k} WHERE nl >= {leaf_rows} AND n - nl >= {leaf_rows}),
best_{k} AS (SELECT leaf, f, c FROM gains_{k}, (SELECT max(gain) AS top FROM gains_{k}) WHERE gain >= top * (1 - 1e-9) ORDER BY leaf, f, c LIMIT 1),
cells_{k + 1} AS (SELECT rooms, bathrooms, n, s, CASE WHEN (CASE f WHEN 0 THEN rooms ELSE bathrooms END) > c THEN {k + 1} ELSE cells_{k}.leaf END AS leaf
                 FROM cells_{k} LEFT JOIN best_{k} USING (leaf))""")
    steps.append(f"leaf_means AS (SELECT leaf, sum(s) / sum(n) AS residual FROM cells_{leaves - 1} GROUP BY leaf)")
    return ",".join(steps)


@query("boosted_leaves", with_clean("""
SELECT t.id, round(m + 0.1 * residual, 2) AS prediction FROM test t JOIN cells_7 USING (rooms, bathrooms) JOIN leaf_means USING (leaf), mean_price""", leafwise_sql(8, 20)))
def boosted_leaves(spark, folder):
    """One leaf-wise tree of eight leaves, which SQL can grow split by split."""
    whole = [F.col(c).cast("double").alias(c) for c in ("rooms", "bathrooms")]
    rows = VectorAssembler(inputCols=["rooms", "bathrooms"], outputCol="features").transform(stored(spark, folder).select("id", TARGET, *whole))
    train, test = sample.train_test(rows)
    return models.boosted(TARGET, rounds=1, leaves=8).fit(train).transform(test).select("id", rounded("prediction", 2))


def levels_sql(depth: int, leaf_rows: int) -> str:
    """The leaves of one tree on rooms and bathrooms, level by level: every node has its own best cut."""
    steps = ["""
mean_price AS (SELECT avg(price_usd) AS m FROM train),
cells_0 AS (SELECT rooms, bathrooms, count(*) FILTER (u >= 858993459) AS n, coalesce(sum(price_usd - m) FILTER (u >= 858993459), 0) AS s, 1 AS node FROM stored, mean_price GROUP BY ALL),
cuts AS (SELECT DISTINCT 0 AS f, rooms AS c FROM cells_0 UNION SELECT DISTINCT 1, bathrooms FROM cells_0)"""]
    for k in range(depth):
        steps.append(f"""
sides_{k} AS (SELECT node, f, c, sum(n) FILTER (CASE f WHEN 0 THEN rooms ELSE bathrooms END <= c) AS nl, sum(s) FILTER (CASE f WHEN 0 THEN rooms ELSE bathrooms END <= c) AS sl, sum(n) AS n, sum(s) AS s
              FROM cells_{k}, cuts GROUP BY ALL),
gains_{k} AS (SELECT node, f, c, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM sides_{k} WHERE nl >= {leaf_rows} AND n - nl >= {leaf_rows}),
tops_{k} AS (SELECT node, f, c FROM gains_{k} QUALIFY gain > 1e-9 AND gain >= max(gain) OVER (PARTITION BY node) * (1 - 1e-9)),
best_{k} AS (SELECT node, f, c FROM tops_{k} QUALIFY row_number() OVER (PARTITION BY node ORDER BY f, c) = 1),
cells_{k + 1} AS (SELECT rooms, bathrooms, n, s, CASE WHEN c IS NULL THEN node WHEN (CASE f WHEN 0 THEN rooms ELSE bathrooms END) > c THEN 2 * node + 1 ELSE 2 * node END AS node
                 FROM cells_{k} LEFT JOIN best_{k} USING (node))""")
    steps.append(f"node_means AS (SELECT node, sum(s) / sum(n) AS residual FROM cells_{depth} GROUP BY node)")
    return ",".join(steps)


@query("forest_tree", with_clean("""
SELECT t.id, round(m + residual, 2) AS prediction FROM test t JOIN cells_4 USING (rooms, bathrooms) JOIN node_means USING (node), mean_price""", levels_sql(4, 20)))
def forest_tree(spark, folder):
    """One tree of a forest on all rows, four splits deep, which SQL can grow level by level."""
    whole = [F.col(c).cast("double").alias(c) for c in ("rooms", "bathrooms")]
    rows = VectorAssembler(inputCols=["rooms", "bathrooms"], outputCol="features").transform(stored(spark, folder).select("id", TARGET, *whole))
    train, test = sample.train_test(rows)
    return models.random_forest(TARGET, trees=1, depth=4, leaf_rows=20, bootstrap=False).fit(train).transform(test).select("id", rounded("prediction", 2))


@query("predictions", with_lines("SELECT model, id, price_usd, round(prediction, 2) AS prediction FROM scored"))
def predictions(spark, folder):
    return scored_lines(spark, folder).select("model", "id", TARGET, rounded("prediction", 2))


@query("test_metrics", with_lines("""
SELECT model, count(*) AS n, round(sqrt(avg((price_usd - prediction) ** 2)), 3) AS rmse, round(avg(abs(price_usd - prediction)), 3) AS mae,
       round(1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)), 6) AS r2 FROM scored GROUP BY model"""))
def test_metrics(spark, folder):
    df = evaluate.metrics(scored_lines(spark, folder), TARGET, "prediction", ["model"])
    return df.select("model", "n", rounded("rmse", 3), rounded("mae", 3), rounded("r2", 6))


@query("train_and_test_metrics", with_lines("""
SELECT model, u < 858993459 AS is_test, count(*) AS n, round(sqrt(avg((price_usd - p) ** 2)), 3) AS rmse, round(avg(abs(price_usd - p)), 3) AS mae,
       round(1 - sum((price_usd - p) ** 2) / (count(*) * var_pop(price_usd)), 6) AS r2
FROM (SELECT model, u, price_usd, intercept + slope * surface_total AS p FROM stored, lines) GROUP BY 1, 2"""))
def train_and_test_metrics(spark, folder):
    rows = one_feature(stored(spark, folder)).withColumn("is_test", sample.is_test(F.col("id")))
    parts = [
        m.fit(rows.where(~F.col("is_test"))).transform(rows).select(F.lit(n).alias("model"), "is_test", TARGET, "prediction")
        for n, m in line_models().items()
    ]
    df = evaluate.metrics(parts[0].unionByName(parts[1]).unionByName(parts[2]), TARGET, "prediction", ["model", "is_test"])
    return df.select("model", "is_test", "n", rounded("rmse", 3), rounded("mae", 3), rounded("r2", 6))


@query("cross_validation", with_lines("SELECT model, CAST(fold AS INTEGER) AS fold, n, round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(r2, 6) AS r2 FROM fold_metrics"))
def cross_validation(spark, folder):
    """One feature through the whole fold loop."""
    return line_folds(spark, folder).select("model", "fold", "n", rounded("rmse", 3), rounded("mae", 3), rounded("r2", 6))


@query("cross_validated_r2", with_lines("SELECT model, round(cv_r2, 6) AS cv_mean, round(cv_r2_std, 6) AS cv_std FROM cv"))
def cross_validated_r2(spark, folder):
    df = evaluate.summarise_folds(line_folds(spark, folder))
    return df.select("model", rounded("cv_mean", 6, "cv_r2_mean"), rounded("cv_std", 6, "cv_r2_std"))


@query("coefficient_importance", with_lines("SELECT model, 'surface_total' AS feature, round(abs(slope), 4) AS importance FROM lines"))
def coefficient_importance(spark, folder):
    train, _ = sample.train_test(one_feature(stored(spark, folder)))
    parts = [
        (n, f, round(w, 4)) for n, m in line_models().items() for f, w in models.importance(m.fit(train), train).items()
    ]
    return spark.createDataFrame(parts, "model string, feature string, importance double")


def compared(rows: DataFrame) -> analysis.Comparison:
    return analysis.compare_models(rows, models.catalogue("core", TARGET), TARGET, parallelism=sample.FOLDS)


# One standardised feature: ridge shrinks the least-squares slope by n / (n + alpha).
COMPARED_SQL = """
shrunk AS (SELECT 'Linear Regression' AS model, 1.0 AS k UNION ALL SELECT 'Ridge', NULL),
cv_scored AS (SELECT s.model, t.fold, price_usd, my + coalesce(k, n / (n + 1.0)) * sxy / sxx * (surface_total - mx) AS prediction
              FROM train t JOIN fold_moments m ON m.fold = t.fold, shrunk s),
cv_folds AS (SELECT model, fold, sqrt(avg((price_usd - prediction) ** 2)) AS rmse, avg(abs(price_usd - prediction)) AS mae,
                    1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)) AS r2 FROM cv_scored GROUP BY model, fold),
cv_means AS (SELECT model, avg(r2) AS cv_r2, avg(rmse) AS cv_rmse, avg(mae) AS cv_mae FROM cv_folds GROUP BY model),
test_scored AS (SELECT s.model, price_usd, my + coalesce(k, n / (n + 1.0)) * sxy / sxx * (surface_total - mx) AS prediction FROM test, moments, shrunk s),
test_figures AS (SELECT model, count(*) AS n, 1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)) AS r2 FROM test_scored GROUP BY model)"""


@query("compared_models", with_lines("""
SELECT model, round(cv_r2, 6) AS cv_r2, round(cv_rmse, 3) AS cv_rmse, round(cv_mae, 3) AS cv_mae, n, round(r2, 6) AS test_r2
FROM cv_means JOIN test_figures USING (model)""", COMPARED_SQL))
def compared_models(spark, folder):
    """The whole comparison on one feature, which SQL can follow: fold means and test figures."""
    result = compared(stored(spark, folder).select("id", "surface_total", TARGET))
    test = result.test_metrics.select("model", "n", rounded("test_r2", 6, "r2"))
    means = reports.comparison(result.summary()).select("model", rounded("cv_r2", 6), rounded("cv_rmse", 3), rounded("cv_mae", 3))
    return means.join(test, "model")


@query("model_importance", with_clean("""
SELECT unnest(['surface', 'rooms', 'bedrooms', 'bathrooms', 'operation', 'property', 'province', 'department']) AS feature_group, TRUE AS weighs
FROM (SELECT count(*) FROM train)"""))
def model_importance(spark, folder):
    """Importance of a ridge model on the full preprocessing, by feature group."""
    _, fit_rows, _ = full_preprocessing(stored(spark, folder))
    weights = models.importance(models.Ridge(labelCol=TARGET).fit(fit_rows), fit_rows)
    return reports.top_groups(reports.importance_frame(spark, weights)).select("feature_group", (F.col("importance") > 0).alias("weighs"))


@query("stored_comparison", with_clean("""
SELECT m AS model_name, 9 AS n_figures, CAST(7 + (SELECT count(DISTINCT operation_type) + count(DISTINCT property_type) FROM train) AS INTEGER) AS n_features
FROM (VALUES ('Linear Regression'), ('Ridge')) t(m)"""))
def stored_comparison(spark, folder):
    """Registry rows of a comparison: nine figures and one weight per feature for each model."""
    result = compared(stored(spark, folder))
    store = ListingStore(spark, scratch_path(spark, "store"))
    analysis.store_comparison(result, store)
    figures = [c for c in store.results_history().columns if c.startswith(("test_", "cv_"))]
    filled = sum((F.col(c).isNotNull().cast("int") for c in figures), F.lit(0))
    return store.results_history().select("model_name", filled.alias("n_figures"), F.size(F.json_object_keys("feature_importance")).alias("n_features"))


@query("stored_figures", with_lines("""
SELECT model AS model_name, round(avg(f.r2), 6) AS cv_r2_mean, round(stddev_pop(f.r2), 6) AS cv_r2_std, round(avg(f.rmse), 3) AS cv_rmse_mean, round(stddev_pop(f.rmse), 3) AS cv_rmse_std,
       round(avg(f.mae), 3) AS cv_mae_mean, any_value(round(t.r2, 6)) AS test_r2, any_value(round(t.rmse, 3)) AS test_rmse, any_value(round(t.mae, 3)) AS test_mae
FROM cv_folds f JOIN test_errors t USING (model) GROUP BY model""", COMPARED_SQL, """
test_errors AS (SELECT model, sqrt(avg((price_usd - prediction) ** 2)) AS rmse, avg(abs(price_usd - prediction)) AS mae,
                       1 - sum((price_usd - prediction) ** 2) / (count(*) * var_pop(price_usd)) AS r2 FROM test_scored GROUP BY model)"""))
def stored_figures(spark, folder):
    """The figures of a comparison on one feature, stored and read back."""
    store = ListingStore(spark, scratch_path(spark, "store"))
    analysis.store_comparison(compared(stored(spark, folder).select("id", "surface_total", TARGET)), store)
    digits = {"cv_r2_mean": 6, "cv_r2_std": 6, "cv_rmse_mean": 3, "cv_rmse_std": 3, "cv_mae_mean": 3, "test_r2": 6, "test_rmse": 3, "test_mae": 3}
    return store.results_history().select("model_name", *[rounded(c, n) for c, n in digits.items()])


@query("scored_request_values", with_lines("""
SELECT id, round(my + n / (n + 1.0) * sxy / sxx * (surface_total - mx), 2) AS predicted_price FROM test, moments"""))
def scored_request_values(spark, folder):
    """A saved ridge model on one standardised feature scores raw requests; its predictions follow from sums."""
    root, rows = scratch_path(spark, "models"), stored(spark, folder)
    train, test = sample.train_test(rows)
    narrow = train.select("id", "surface_total", TARGET)
    fitted = encode.preprocessor(narrow, TARGET).fit(narrow)
    ridge = models.Ridge(labelCol=TARGET).fit(encode.encode(fitted, narrow, ["id", TARGET]))
    scoring.save_model(PipelineModel(stages=[*fitted.stages, ridge]), root, "Ridge")
    requests = test.drop(TARGET).withColumn("province", F.upper("province"))
    return scoring.score(scoring.load_models(spark, root)["Ridge"], requests).select("id", rounded("predicted_price", 2))


@query("engineered_features", with_clean("""
SELECT CAST(id AS VARCHAR) AS property_id, round(surface_ratio, 9) AS surface_ratio, CAST(total_rooms AS DOUBLE) AS total_rooms, round(room_density, 9) AS room_density,
       ['Muy Pequeña', 'Pequeña', 'Mediana', 'Grande', 'Muy Grande'][surface_bin] AS surface_category FROM featured"""))
def engineered_features(spark, folder):
    """Derived columns of the stored listings, read back from their raw rows."""
    rows = analysis.model_rows(store_all(spark, folder).read_listings(), TARGET, engineered=True)
    return rows.select("property_id", rounded("surface_ratio", 9), "total_rooms", rounded("room_density", 9), "surface_category")


@query("engineered_coefficients", with_clean("""
SELECT feature, round(regr_slope(price_usd, x) * stddev_pop(x), 2) AS slope FROM (
  SELECT unnest(['surface_ratio', 'room_density']) AS feature, unnest([surface_ratio, room_density]) AS x, t.price_usd FROM train t JOIN featured f USING (id)) GROUP BY feature"""))
def engineered_coefficients(spark, folder):
    """A least-squares fit on a derived column of stored listings, standardised, with ``property_id`` deciding the split."""
    train, _ = sample.train_test(analysis.model_rows(store_all(spark, folder).read_listings(), TARGET, engineered=True), identity="property_id")
    found = []
    for name in ("surface_ratio", "room_density"):
        rows = train.select("property_id", name, TARGET)
        encoded = encode.encode(encode.preprocessor(rows, TARGET).fit(rows), rows, [TARGET])
        found.append((name, round(float(models.linear(TARGET).fit(encoded).coefficients[0]), 2)))
    return spark.createDataFrame(found, "feature string, slope double")


@query("model_catalogue", with_clean("""
SELECT kind, m AS model, n FROM (VALUES ('core', 'Linear Regression'), ('core', 'Ridge'), ('full', 'Linear Regression'), ('full', 'Ridge'), ('full', 'Lasso'), ('full', 'Random Forest'), ('full', 'Boosted Trees'),
  ('trainer', 'Linear Regression'), ('trainer', 'Ridge Regression'), ('trainer', 'Lasso Regression'), ('trainer', 'Random Forest'), ('trainer', 'Gradient Boosting')) t(kind, m), (SELECT count(*) AS n FROM train)"""))
def model_catalogue(spark, folder):
    """The named sets of models, with the rows that they would be trained on."""
    n = sample.train_test(stored(spark, folder))[0].count()
    return spark.createDataFrame([(kind, name, n) for kind in ("core", "full", "trainer") for name in models.catalogue(kind, TARGET)], "kind string, model string, n bigint")


FULL_SQL = """
SELECT m AS model, n, stump_r2, TRUE AS beats_stump FROM (VALUES ('Linear Regression'), ('Ridge'), ('Lasso'), ('Random Forest'), ('Boosted Trees')) t(m),
(SELECT count(*) AS n, round(1 - sum((price_usd - p) ** 2) / (count(*) * var_pop(price_usd)), 6) AS stump_r2 FROM stumped)"""


@query("compared_full", with_clean(FULL_SQL, STUMP_SQL))
def compared_full(spark, folder):
    """The five models of the full set on all columns, cross-validated side by side; each must predict better than a stump, on the test rows and in the mean of the folds."""
    rows = stored(spark, folder)
    result = analysis.compare_models(rows, models.catalogue("full", TARGET), TARGET, parallelism=sample.FOLDS, side_by_side=2)
    stump = stump_r2(*sample.train_test(rows)).select("stump_r2")
    figures = result.test_metrics.join(result.summary(), "model").select("model", "n", F.least("r2", "cv_r2_mean").alias("r2"))
    return figures.join(stump, F.col("r2") > F.col("stump_r2"), "left").select("model", "n", "stump_r2", F.col("stump_r2").isNotNull().alias("beats_stump"))


@query("predicted_and_actual", with_lines("""
SELECT price_usd AS actual, round(prediction, 2) AS predicted, min(price_usd) OVER () AS diagonal_low, max(price_usd) OVER () AS diagonal_high
FROM scored WHERE model = 'Linear Regression'"""))
def predicted_and_actual(spark, folder):
    pairs = evaluate.prediction_pairs(scored_lines(spark, folder, ("Linear Regression",)), TARGET)
    return pairs.select("actual", rounded("predicted", 2), "diagonal_low", "diagonal_high")


@query("scored_requests", with_clean("SELECT id, TRUE AS same FROM test"))
def scored_requests(spark, folder):
    """A saved ridge model on the full preprocessing scores listings in raw spelling as the unsaved one does."""
    root = scratch_path(spark, "models")
    fitted, fit_rows, test = full_preprocessing(stored(spark, folder))
    model = PipelineModel(stages=[*fitted.stages, models.Ridge(labelCol=TARGET).fit(fit_rows)])
    scoring.save_model(model, root, "Ridge")
    requests = test.drop(TARGET).withColumn("property_type", F.lower("property_type"))
    again = scoring.score(scoring.load_models(spark, root)["Ridge"], requests)
    direct = model.transform(test).select("id", "prediction")
    return again.join(direct, "id").select("id", (F.abs(F.col("predicted_price") - F.col("prediction")) < 1e-6).alias("same"))


@query("surface_price_sample", with_clean("""
SELECT surface_total, price_usd, property_type FROM (SELECT * FROM stored ORDER BY md5(id::VARCHAR || '|42'), id LIMIT 2000)"""))
def surface_price_sample(spark, folder):
    return profile.scatter(sample.random_sample(featured(spark, folder)))


@query("surface_price_trimmed", with_clean("""
SELECT surface_total, price_usd, property_type FROM stored, (SELECT quantile_cont(surface_total, 0.99) AS a, quantile_cont(price_usd, 0.99) AS b FROM stored)
WHERE surface_total < a AND price_usd < b"""))
def surface_price_trimmed(spark, folder):
    return profile.scatter(profile.trim_plot(stored(spark, folder)))
