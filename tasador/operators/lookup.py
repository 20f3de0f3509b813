"""Left join with a lookup table whose size is checked first and whose hot keys are spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 100_000
HOT_SHARES = 1_000


def small_enough(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """True if the table has at most ``rows`` rows; reads no more than that."""
    return table.limit(rows + 1).count() <= rows


def lookup(
    df: DataFrame, table: DataFrame, key: str, weight: str, rows: int | None = None, broadcast_rows: int | None = None
) -> DataFrame:
    """Add the columns of ``table`` to every row of ``df`` with the same ``key``.

    ``table`` holds each key once, and in ``weight`` the rows of ``df`` expected for it. A small
    table is broadcast. Of a large one only the keys above one thousandth of all rows are
    (there can be at most a thousand of them); the rest is shuffled, and the rows already
    served go to random partitions, so that no hot key meets in one task. ``rows`` is the size
    of the table if it has been counted before.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    added = [c for c in table.columns if c not in (key, weight)]
    if rows <= limit if rows is not None else small_enough(table, limit):
        return df.join(F.broadcast(table.drop(weight)), key, "left")
    total = table.agg(F.sum(weight)).first()[0]
    is_hot = F.col(weight) * HOT_SHARES >= total
    hot = table.where(is_hot).select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in added])
    cold = table.where(~is_hot).select(F.col(key).alias("_key"), *added)
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spread = F.concat(F.lit("\x00"), F.xxhash64(*plain).cast("string"))
    served = df.join(F.broadcast(hot), key, "left").withColumn("_key", F.when(F.col("_hot"), spread).otherwise(F.col(key)))
    joined = served.join(cold, "_key", "left")
    return joined.select(
        *df.columns, *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in added]
    )
