"""Deterministic pseudo-random keys: the same on every engine, cluster size and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_key(identity: Column, seed: int, salt: str = "") -> Column:
    """A 128-bit hexadecimal text, uniform over identities."""
    return F.md5(F.concat(identity.cast("string"), F.lit(f"|{salt}{seed}")))


def random_unit(key: Column) -> Column:
    """The first 32 bits of a random key as a whole number in 0 .. 2**32-1."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def bucket(identity: Column, buckets: int, seed: int, salt: str = "") -> Column:
    return (random_unit(random_key(identity, seed, salt)) % buckets).cast("int")
