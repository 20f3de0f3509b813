"""Data quality and distribution figures. Every result is a small DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial, isfinite

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.numeric import numeric_columns
from tasador.operators.features import value_range
from tasador.operators.quantiles import exact_quantiles, grouped_quantiles
from tasador.session import durable

# Bins of the histograms, points of the density curve, quantile of the plot trim, alarm share.
PRICE_BINS = 50
RESIDUAL_BINS = 30
DENSITY_POINTS = 200
TRIM_QUANTILE = 0.99
MISSING_ALARM = 20.0

# Density series: terms per cell, cells per bandwidth, and how many bandwidths a cell reaches.
TERMS = 14
CELLS = 2
REACH = 9

# Relative size below which a centred sum of squares is rounding noise.
NO_VARIANCE = 1e-12
# Groups in which the sums of tasks are added up first.
SUM_PARTS = 256


def _literal(value: float | None) -> Column:
    return F.lit(value).cast("double")


def describe(df: DataFrame, column: str = "price_usd") -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum in one row."""
    quartiles = exact_quantiles(df, {column: (0.25, 0.5, 0.75)})[column]
    value = F.col(column)
    return df.agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        *[F.max(_literal(q)).alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles)],
        F.max(value).alias("max"),
    )


def price_statistics(df: DataFrame, column: str = "price_usd") -> DataFrame:
    median = exact_quantiles(df, {column: (0.5,)})[column][0]
    value = F.col(column)
    return df.agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.max(_literal(median)).alias("median")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: ``column``, ``n_missing``, ``n_rows``."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{c}") for c in df.columns]
    )
    long = counted.unpivot("n_rows", [f"m_{c}" for c in df.columns], "column", "n_missing")
    return long.select(F.substring("column", 3, 1 << 16).alias("column"), "n_missing", "n_rows")


def null_percent(df: DataFrame, alarm: float = MISSING_ALARM) -> DataFrame:
    """Columns with missing values, most first, and whether they exceed the alarm share."""
    percent = F.try_divide(F.col("n_missing") * F.lit(100.0), F.col("n_rows"))
    return (
        null_counts(df).where(F.col("n_missing") > 0)
        .select("column", percent.alias("percent"), (percent > alarm).alias("above_alarm"))
        .orderBy(F.desc("percent"), "column")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable, and the class used to pick columns."""
    numbers = set(numeric_columns(df))
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, "numeric" if f.name in numbers else "text" if f.dataType.simpleString() == "string" else "other")
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean, class string")


def histogram(df: DataFrame, value: str | Column, bins: int = PRICE_BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty ones kept.

    If all values are equal the range is widened by a half on both sides.
    """
    values = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v"))
    limits = value_range(values, "v")
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if limits is None:
        return grid.select("bin", _literal(None).alias("low"), _literal(None).alias("high"), F.lit(0).cast("bigint").alias("n"))
    low, high = limits if limits[0] < limits[1] else (limits[0] - 0.5, limits[1] + 0.5)
    width = (high - low) / bins
    number = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counted = values.where(F.col("v").isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _hermite(terms: int) -> list[list[int]]:
    """Coefficients, lowest power first, of the probabilists' Hermite polynomials."""
    rows = [[1], [0, 1]]
    for k in range(1, terms):
        shifted, back = [0] + rows[k], rows[k - 1]
        rows.append([c - (k * back[i] if i < len(back) else 0) for i, c in enumerate(shifted)])
    return rows[:terms]


def density(df: DataFrame, value: str | Column, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian density curve on a grid from minimum to maximum, bandwidth n^(-1/5) times the deviation.

    A sum over all pairs of row and grid point is not needed: rows are first reduced to power
    sums in cells of half a bandwidth, in one map-side combined aggregate, and the kernel is
    expanded around the cell centres. With 14 terms the error is below 1e-13 of the kernel peak.
    """
    spark = df.sparkSession
    values = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v")).where("v IS NOT NULL")
    n, deviation, low, high = values.agg(F.count("v"), F.stddev_samp("v"), F.min("v"), F.max("v")).first()
    grid = spark.range(points).select(F.col("id").cast("int").alias("point"))
    if n < 2 or not deviation or not isfinite(deviation):
        return grid.select("point", _literal(low).alias("x"), _literal(None).alias("density"))
    band = deviation * n ** (-0.2)
    step = (high - low) / (points - 1)
    size = band / CELLS
    cell = F.floor((F.col("v") - low) / size)
    offset = (F.col("v") - (F.lit(low) + (cell + 0.5) * size)) / band
    cells = (
        values.select(cell.alias("cell"), offset.alias("t"))
        .groupBy("cell")
        .agg(*[F.sum(F.pow("t", F.lit(k)) if k > 1 else (F.col("t") if k else F.lit(1.0))).alias(f"s{k}") for k in range(TERMS)])
        .withColumn("centre", F.lit(low) + (F.col("cell") + 0.5) * size)
    )
    first = F.greatest(F.ceil((F.col("centre") - REACH * band - low) / step), F.lit(0))
    last = F.least(F.floor((F.col("centre") + REACH * band - low) / step), F.lit(points - 1))
    near = cells.where(first <= last).withColumn("point", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    near = near.withColumn("u", (F.lit(low) + F.col("point") * step - F.col("centre")) / band)
    series = F.lit(0.0)
    for k, coefficients in enumerate(_hermite(TERMS)):
        polynomial = F.lit(0.0)
        for c in reversed(coefficients):
            polynomial = polynomial * F.col("u") + F.lit(float(c))
        series = series + polynomial * F.col(f"s{k}") / F.lit(float(factorial(k)))
    kernel = F.exp(-F.col("u") * F.col("u") / 2) * series
    summed = near.groupBy("point").agg(F.sum(kernel).alias("total"))
    scale = 1.0 / (n * band * (2 * 3.141592653589793) ** 0.5)
    return grid.join(summed, "point", "left").select(
        "point", (F.lit(low) + F.col("point") * step).alias("x"), (F.coalesce("total", F.lit(0.0)) * scale).alias("density")
    )


def pair_sums(values: DataFrame, centres: list[float], size: int) -> np.ndarray:
    """For every pair of columns the number of rows where both are present, and their sums of x, y, x * x, y * y and x * y there, x and y less their centres: arrays of size by size.

    Gaps count 0 in a block of values and in one of marks; products of these blocks are the sums of all pairs at once. A task sends six numbers for each pair, whatever its rows.
    """

    def run(batches):
        total = np.zeros((4, size, size))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(size)], 1) if batch.num_rows else np.zeros((0, size))
            here = (~np.isnan(x)).astype(float)
            x = np.where(here > 0, x - np.array(centres), 0.0)
            total += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        part = TaskContext.get().partitionId() % parts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array([part] * size, pa.int32()), pa.array([total[:, i].tobytes() for i in range(size)], pa.binary())], names=["i", "part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b) for b in table.column("sums").to_pylist()], 0)
        return pa.table({"i": table.column("i")[:1], "part": table.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    kind, parts, out = "i int, part int, sums binary", SUM_PARTS, np.zeros((4, size, size))
    by_part = values.mapInArrow(run, kind).groupBy("i", "part").applyInArrow(add, kind)
    for r in by_part.groupBy("i").applyInArrow(add, kind).collect():  # the square of the number of columns
        out[:, r.i] = np.frombuffer(r.sums).reshape(4, size)
    n, sx, sxx, sxy = out
    return np.stack([n, sx, sx.T, sxx, sxx.T, sxy])


def correlations(df: DataFrame, drop: Sequence[str] = ("id",)) -> DataFrame:
    """Pearson matrix of the numeric columns in long form, rows complete for each pair.

    A first aggregate finds means and constant columns, a second pass takes the centred sums of all pairs as products of blocks.
    No variance gives NULL, fewer than two columns no row.
    """
    names, spark = numeric_columns(df, drop), df.sparkSession
    schema = "a string, b string, r double"
    if len(names) < 2:
        return spark.createDataFrame([], schema)
    values = df.select(*[F.when(~F.isnan(F.col(f"`{n}`").cast("double")), F.col(f"`{n}`").cast("double")).alias(f"v{i}") for i, n in enumerate(names)])
    first = values.agg(*[f(c) for c in values.columns for f in (F.avg, F.min, F.max)]).first()
    means = [first[3 * i] or 0.0 for i in range(len(names))]
    constant = np.array([first[3 * i + 1] is None or first[3 * i + 1] == first[3 * i + 2] for i in range(len(names))])
    n, sx, sy, sxx, syy, sxy = pair_sums(values, means, len(names))
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        r = np.clip((sxy - sx * sy / n) / (np.sqrt(vx) * np.sqrt(vy)), -1.0, 1.0)
        fine = (vx > sxx * NO_VARIANCE) & (vy > syy * NO_VARIANCE) & ~constant[:, None] & ~constant[None, :]
    np.fill_diagonal(r, 1.0)
    np.fill_diagonal(fine, ~constant)
    size = len(names)
    table = pa.table({"a": np.repeat(names, size).tolist(), "b": names * size, "r": pa.array(r.ravel(), mask=~fine.ravel())})
    return spark.createDataFrame(table).select("a", "b", "r")


def locations(df: DataFrame) -> DataFrame:
    return df.select("province", "department").distinct().orderBy("province", "department")


def provinces(df: DataFrame) -> DataFrame:
    return df.select("province").distinct()


def departments_of(df: DataFrame, province: str) -> DataFrame:
    return df.where(F.col("province") == province).select("department").distinct()


def trim_plot(df: DataFrame, columns: Sequence[str] = ("surface_total", "price_usd"), quantile: float = TRIM_QUANTILE) -> DataFrame:
    """Rows strictly below the quantile of every column; all quantiles are of the whole frame."""
    limits = exact_quantiles(df, {c: (quantile,) for c in columns})
    for c in columns:
        df = df.where(F.col(c) < _literal(limits[c][0]))
    return df


def scatter(df: DataFrame) -> DataFrame:
    return df.select("surface_total", "price_usd", "property_type")


def price_by(df: DataFrame, keys: Sequence[str], price: str = "price_usd") -> DataFrame:
    """Listings, share of all listings, mean and median price per group.

    The mean is a decimal sum over the count, so it does not depend on the order of the rows.
    """
    value = F.col(price)
    groups = durable(
        df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(value.isNotNull() & ~F.isnan(value)).alias("size"),
            F.try_divide(F.sum(value.cast("decimal(18,2)")).cast("double"), F.count(value)).alias("mean_price"),
        ),
        "groups",
    )
    total = groups.agg(F.sum("n")).first()[0]
    medians = grouped_quantiles(df, keys, price, (0.5,), sizes=groups.select(*keys, "size")).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("quantiles")[0].alias("median_price")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return groups.join(medians, same, "left").select(
        *keys, "n", F.try_divide(F.col("n"), F.lit(total)).alias("share"), "mean_price", "median_price"
    )


def first_rows(df: DataFrame, order_by: str, rows: int = 5) -> DataFrame:
    return df.orderBy(order_by).limit(rows)


def residual_histogram(predictions: DataFrame, actual: str, predicted: str, bins: int = RESIDUAL_BINS) -> DataFrame:
    return histogram(predictions, F.col(actual) - F.col(predicted), bins)
