"""One-hot encoding of columns with many categories: the dictionary is a table, and vectors are put together without a list of all categories anywhere on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasador.functions.text import MARK
from tasador.operators.encode import TableReader, TableWriter
from tasador.operators.lookup import lookup, small_enough
from tasador.session import durable

#: Categories of a column up to which the driver holds them, for names in the column metadata.
NAMED = 10_000


def ranked_categories(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``counts`` (column, category, ...) of the named columns with the place of each category in its column, from 0, by a distributed sort; stored.

    The rows are sorted by ranges, each task numbers its own, and the rows of a column in the tasks before are added: only a row for each column and task is brought together.
    """
    ordered = durable(counts.where(F.col("column").isin(*columns)).orderBy("column", "category").withColumn("_tag", F.monotonically_increasing_id()), "sorted")
    runs = ordered.groupBy("column", F.shiftright("_tag", 33).alias("_task")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_tag").alias("_first"))
    before = F.sum("_rows").over(Window.partitionBy("column").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(F.col("column").alias("_of"), "_task", "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    side = F.broadcast(starts) if small_enough(starts) else starts
    joined = ordered.join(side, (F.col("column") == F.col("_of")) & (F.shiftright("_tag", 33) == F.col("_task")))
    return durable(joined.withColumn("index", (F.col("_start") + F.col("_tag") - F.col("_first")).cast("int")).drop("_of", "_task", "_first", "_start", "_tag"), "ranked")


class CategoryIndexModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """The place of each category in its column, -1 for one that is not there. ``table``: column, category, n (rows expected) and index."""

    sizes = Param(Params._dummy(), "sizes", "categories per column", TypeConverters.toListInt)
    table: DataFrame

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, sizes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out, size in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("sizes")):
            known = self.table.where(F.col("column") == column).select(F.col("category").alias("_key"), "n", "index")
            joined = lookup(dataset.withColumn("_key", F.col(column)), known, "_key", "n", rows=size)
            dataset = joined.withColumn(out, F.coalesce(F.col("index"), F.lit(-1)).cast("double")).drop("_key", "index")
        return dataset

    def write(self) -> MLWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls)


class SparseAssembler(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One sparse vector from numbers and from places of categories, in the order of the columns. ``sizes``: 0 for a number, the number of categories for a place; a place outside has no entry."""

    sizes = Param(Params._dummy(), "sizes", "0 for a number, else the number of categories", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, sizes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes = self.getOrDefault("sizes")
        width = np.maximum(sizes, 1)
        offsets, total = np.cumsum(width) - width, int(width.sum())

        def assemble(*columns: pa.Array) -> pa.Array:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], 1)
            category = np.array(sizes) > 0
            here = np.where(category, (x >= 0) & (x < width), x != 0)
            at = (offsets + np.where(category, np.where(here, x, 0), 0)).astype(np.int32)
            value = np.where(category, 1.0, x)
            bounds = pa.array(np.concatenate([[0], np.cumsum(here.sum(1))]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(part[here])) for part in (at, value)]
            return pa.StructArray.from_arrays([pa.array(np.zeros(len(x)), pa.int8()), pa.array(np.full(len(x), total), pa.int32()), *lists], names=["type", "size", "indices", "values"])

        inputs = [F.col(f"`{c}`").cast("double") for c in self.getInputCols()]
        return dataset.withColumn(self.getOutputCol(), F.arrow_udf(assemble, VectorUDT())(*inputs))


def feature_table(model: PipelineModel, spark) -> DataFrame:
    """position and feature: the names of a vector put together by :class:`SparseAssembler`, as a table."""
    assembler = model.stages[-1]
    small, wide, offset, of = [], [], 0, {}
    for stage in model.stages:
        if isinstance(stage, CategoryIndexModel):
            of.update({out: (stage.table, c) for c, out in zip(stage.getInputCols(), stage.getOutputCols())})
        elif isinstance(stage, StringIndexerModel):
            of[stage.getOutputCol()] = stage.labels
    for column, size in zip(assembler.getInputCols(), assembler.getOrDefault("sizes")):
        name = column.removeprefix("_index_")
        if not size:
            small.append((offset, column))
        elif isinstance(of[column], tuple):
            table, source = of[column]
            wide.append(table.where(F.col("column") == source).select((F.col("index") + F.lit(offset)).cast("long").alias("position"), F.concat(F.lit(f"cat_low__{name}_"), "category").alias("feature")))
        else:
            small += [(offset + i, f"cat_low__{name}_{label.replace(MARK, '')}") for i, label in enumerate(of[column])]
        offset += max(size, 1)
    whole = spark.createDataFrame(small, "position long, feature string")
    for part in wide:
        whole = whole.unionByName(part)
    return whole
