"""Samples and splits by a hash of the row identity: repeatable whatever the partitioning."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tasador.functions.hashing import bucket, random_key, random_unit
from tasador.operators.quantiles import exact_quantiles

# Seed, share of test rows, folds, sample sizes.
SEED = 42
TEST_SHARE = 0.2
FOLDS = 5
SCATTER_ROWS = 2_000
SAMPLE_ROWS = 50_000
STRATA = 10

UNITS = 1 << 32
FOLD_SALT = "fold"
INNER_SALT = "inner"


def random_sample(df: DataFrame, size: int = SCATTER_ROWS, identity: str = "id", seed: int = SEED) -> DataFrame:
    """Exactly min(size, rows) rows: those with the smallest hash.

    A threshold on the hash, from the number of rows, drops nearly all others before the sort, so that what meets in one task grows with ``size`` and not with the tasks.
    """
    total, spare = df.count(), 6.0
    if total <= size:
        return df
    while True:
        part = (size + spare * sqrt(size) + 10) / total
        near = df.where(random_unit(random_key(F.col(identity), seed)) < min(UNITS, int(UNITS * part)))
        if part >= 1 or near.count() >= size:
            return near.orderBy(random_key(F.col(identity), seed), identity).limit(size)
        spare *= 4


def is_test(identity: Column, share: float = TEST_SHARE, seed: int = SEED) -> Column:
    return random_unit(random_key(identity, seed)) < int(share * UNITS)


def train_test(
    df: DataFrame, share: float = TEST_SHARE, identity: str = "id", seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    test = is_test(F.col(identity), share, seed)
    return df.where(~test), df.where(test)


def add_fold(df: DataFrame, name: str = "fold", folds: int = FOLDS, identity: str = "id", seed: int = SEED) -> DataFrame:
    return df.withColumn(name, bucket(F.col(identity), folds, seed, FOLD_SALT))


def add_inner_fold(df: DataFrame, name: str, folds: int = FOLDS, identity: str = "id", seed: int = SEED) -> DataFrame:
    return df.withColumn(name, bucket(F.col(identity), folds, seed, INNER_SALT))


def allocate(counts: dict[int, int], size: int) -> dict[int, int]:
    """Share ``size`` over strata in proportion to their rows; the shares add up to ``size``."""
    total, passed, out = sum(counts.values()), 0, {}
    for stratum in sorted(counts):
        before = passed * size // total
        passed += counts[stratum]
        out[stratum] = passed * size // total - before
    return out


def stratified_sample(
    df: DataFrame, size: int = SAMPLE_ROWS, column: str = "price_usd", identity: str = "id",
    strata: int = STRATA, seed: int = SEED,
) -> DataFrame:
    """About the same distribution of ``column`` in exactly ``size`` rows; all rows if there are no more.

    Strata are equal-count ranges of the column, and one for missing values. Within a stratum the rows with
    the smallest hash are taken. A threshold on the hash first drops nearly all others, so
    that the ranking sees little more than ``size`` rows however many there are.
    """
    edges = exact_quantiles(df, {column: [k / strata for k in range(1, strata)]})[column]
    value = F.col(column).cast("double")
    known = value.isNotNull() & ~F.isnan(value)
    number = F.lit(1)
    for edge in edges if edges[0] is not None else []:
        number = number + (value > edge).cast("int")
    tagged = df.withColumn("_stratum", F.when(known, number).otherwise(0)).withColumn(
        "_key", random_key(F.col(identity), seed)
    )
    counts = {r[0]: r[1] for r in tagged.groupBy("_stratum").count().collect()}
    if sum(counts.values()) <= size:
        return df
    shares = allocate(counts, size)
    spare = 6.0
    while True:
        limit = F.lit(0)
        for s, n in shares.items():
            wanted = n + spare * sqrt(n) + 10
            limit = F.when(F.col("_stratum") == s, F.lit(min(UNITS, int(UNITS * wanted / counts[s])))).otherwise(limit)
        near = tagged.where(random_unit(F.col("_key")) < limit)
        got = {r[0]: r[1] for r in near.groupBy("_stratum").count().collect()}
        if all(got.get(s, 0) >= n for s, n in shares.items()):
            break
        spare *= 4
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_key", identity))
    share = F.lit(0)
    for s, n in shares.items():
        share = F.when(F.col("_stratum") == s, F.lit(n)).otherwise(share)
    return near.withColumn("_rank", rank).where(F.col("_rank") <= share).drop("_rank", "_key", "_stratum")
