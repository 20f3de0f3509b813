"""Listings assembled from the star-schema Parquet tables that stand in for a raw listing file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The countries that the stand-in listings treat as valid.
COUNTRIES = ("AMERICA", "ASIA")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """One raw listing per order: sizes from its lines, place from its customer.

    The dimension joins come first so that filters on country and operation shrink the orders
    before they meet the aggregated lines. Catalyst picks broadcasts from the table sizes.
    """
    line = table(spark, folder, "lineitem")
    lines = line.groupBy(F.col("l_orderkey").alias("id")).agg(
        (F.sum("l_quantity") * 10).alias("surface_total"),
        (F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))) * 10).alias("surface_covered"),
        F.count(F.lit(1)).alias("rooms"),
        F.sum(F.when(F.col("l_linestatus") == "O", 1)).alias("bedrooms"),
        F.max("l_linenumber").alias("bathrooms"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
    )
    places = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select(
            "c_custkey",
            F.col("r_name").alias("l1"),
            F.col("n_name").alias("l2"),
            F.when(F.col("c_mktsegment") != "FURNITURE", F.concat_ws("/", "n_name", "c_mktsegment")).alias("l3"),
        )
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", "Venta")
        .when(F.col("o_orderstatus") == "O", "Alquiler")
        .otherwise("Alquiler temporal")
        .alias("operation_type"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("property_type"),
    )
    return (
        orders.join(places, F.col("c_custkey") == F.col("o_custkey"))
        .join(lines, "id", "left")
        .select(
            "id", "l1", "l2", "l3", "operation_type", "property_type",
            "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms", "price",
        )
    )
