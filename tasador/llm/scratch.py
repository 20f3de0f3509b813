"""Stored intermediate tables and work that is dealt out by key in packs."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.session import durable

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession):
    """Within this block, the shuffle files of a finished query are removed at once: each step is stored, so none is needed again."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files are dropped."""
    with released(df.sparkSession):
        return durable(df, name)


def bit_table(places: DataFrame, size: int) -> np.ndarray:
    """A table of ``size`` bits, a multiple of 32,768, with the bits of the column ``place`` set: the executors make it, in parts of 4 KB, and one job brings it."""
    table, place = np.zeros(size // 8, np.uint8), F.col("place") + 1
    parts = places.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    for r in parts.collect():  # size / 32768 rows at the most
        table[4096 * (r.part - 1) : 4096 * r.part] = np.frombuffer(bytes(r.bits), np.uint8)
    return table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, as their Python workers import it."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tasador-")) / "tasador_source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; other columns, whatever they are called, play no part."""
    ship(df.sparkSession)
    return df.select(*[F.col(f"`{n}`") for n in names])
