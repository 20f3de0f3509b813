"""Preprocessing learned on training rows: numeric block, text block, target encoding, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
    MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.numeric import numeric_columns, text_columns
from tasador.functions.text import MARK
from tasador.operators.lookup import lookup
from tasador.operators.quantiles import exact_quantiles
from tasador.session import durable

# Columns that are never features, columns with many categories, text of an unknown category.
NON_FEATURES = ("id", "property_id", "location", "state_name", "raw_data", "created_at")
HIGH_CARDINALITY = ("province", "department")
UNKNOWN = "Desconocido"

INNER_FOLD = "_inner_fold"
OUTER_FOLD = "_outer_fold"
INTERNAL = (INNER_FOLD, OUTER_FOLD, "_held")


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of the present values; 0 for a column without any."""
    if not columns:
        return {}
    found = exact_quantiles(df, {c: (0.5,) for c in columns})
    return {c: 0.0 if found[c][0] is None else float(found[c][0]) for c in columns}


def imputed(column: str, median: float) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(median))


def fit_scales(df: DataFrame, medians: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation after imputation; a constant column has scale 1."""
    if not medians:
        return {}
    row = df.agg(*[f(imputed(c, m)) for c, m in medians.items() for f in (F.avg, F.stddev_pop)]).first()
    return {c: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, c in enumerate(medians)}


class _Columns(HasInputCols, HasOutputCols):
    def _columns(self):
        return list(zip(self.getInputCols(), self.getOutputCols()))


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    pass


class NumericBlock(Estimator, _Columns, _Saved):
    """Median imputation, then centring and scaling with the population deviation."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NumericBlockModel":
        medians = fit_medians(dataset, self.getInputCols())
        scales = fit_scales(dataset, medians)
        model = NumericBlockModel(
            medians=list(medians.values()), means=[m for m, _ in scales.values()], scales=[s for _, s in scales.values()]
        )
        return self._copyValues(model)


class NumericBlockModel(Model, _Columns, _Saved):
    medians = Param(Params._dummy(), "medians", "median per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "scale per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, medians=None, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        learned = zip(self.getOrDefault("medians"), self.getOrDefault("means"), self.getOrDefault("scales"))
        return dataset.withColumns(
            {out: (imputed(c, med) - F.lit(mean)) / F.lit(scale) for (c, out), (med, mean, scale) in zip(self._columns(), learned)}
        )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) of all columns in one map-side combined pass; missing values left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text per column, the smallest one on a tie."""
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("minus"), "value")).alias("best"))
    found = {r["column"]: r["best"]["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


class ModeImputer(Estimator, _Columns, _Saved):
    """Replace missing texts by the most frequent one."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        modes = fit_modes(dataset, self.getInputCols())
        return self._copyValues(ModeImputerModel(modes=[m if m is not None else "" for m in modes.values()]))


class ModeImputerModel(Model, _Columns, _Saved):
    modes = Param(Params._dummy(), "modes", "most frequent text per column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {out: F.coalesce(F.col(c).cast("string"), F.lit(m)) for (c, out), m in zip(self._columns(), self.getOrDefault("modes"))}
        )


class CategoryLabels(Transformer, _Columns, _Saved):
    """Give the empty text a label for the time it names a feature: names must not be empty, and no real text holds the mark."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({out: F.when(F.col(c) == "", F.lit(MARK)).otherwise(F.col(c)) for c, out in self._columns()})


def known_category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))


def merged_parts(parts: Column) -> tuple[Column, Column, Column]:
    """Rows, mean and sum of squared deviations over an array of parts that hold the same."""
    n = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, q: a + q["n"])
    total = F.aggregate(parts, F.lit(0.0), lambda a, q: a + q["n"] * q["mean"])
    mean = F.try_divide(total, n)
    return n, mean, F.aggregate(parts, F.lit(0.0), lambda a, q: a + q["m2"] + q["n"] * (q["mean"] - mean) * (q["mean"] - mean))


def encoding_of(parts: Column, mean: Column, variance: Column) -> Column:
    """Mean of a category drawn towards the overall mean, the more the noisier the category is."""
    n, own, squares = merged_parts(parts)
    trust = F.try_divide(variance * n, variance * n + F.try_divide(squares, n))
    return F.coalesce(trust * own + (1 - trust) * mean, mean)


class _EncoderParams(HasInputCols, HasOutputCols, HasLabelCol):
    foldCol = Param(Params._dummy(), "foldCol", "column with the inner fold of training rows", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(foldCol=INNER_FOLD)

    def _columns(self):
        return list(zip(self.getInputCols(), self.getOutputCols()))


class FoldTargetEncoder(Estimator, _EncoderParams, _Saved):
    """Target encoding that hides from every training row the targets of its own inner fold.

    One aggregate by (column, category, fold) serves both paths: a row with an inner fold is
    encoded from the other folds, a row without one (held-out or new) from all training rows.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol=None, foldCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FoldTargetEncoderModel":
        label = F.col(self.getLabelCol()).cast("double")
        fold_name = self.getOrDefault("foldCol")
        has_fold = fold_name in dataset.columns
        fold = F.coalesce(F.col(fold_name).cast("int"), F.lit(-1)) if has_fold else F.lit(-1)
        rows = dataset.where(label.isNotNull()).select(
            fold.alias("fold"), label.alias("y"), *[known_category(c).alias(c) for c in self.getInputCols()]
        )
        parts = rows.groupBy("fold").agg(F.count("y"), F.avg("y"), F.var_pop("y")).collect()
        moments = _other_moments({r[0]: (r[1], r[2], r[3]) for r in parts})
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in self.getInputCols()])
        by_fold = (
            rows.select("fold", "y", F.inline(pairs)).groupBy("column", "category", "fold")
            .agg(F.count("y").alias("n"), F.avg("y").alias("mean"), (F.count("y") * F.var_pop("y")).alias("m2"))
        )
        whole = by_fold.groupBy("column", "category").agg(
            F.sort_array(F.collect_list(F.struct("fold", "n", "mean", "m2"))).alias("parts")
        )
        mean = F.create_map(*[F.lit(v) for f, (m, _) in moments.items() for v in (f, m)])
        variance = F.create_map(*[F.lit(v) for f, (_, w) in moments.items() for v in (f, w)])

        def without(p: Column) -> Column:
            others = F.filter("parts", lambda q: q["fold"] != p["fold"])
            encoding = encoding_of(others, mean[p["fold"]], variance[p["fold"]])
            return F.struct(p["fold"].alias("fold"), p["n"].alias("n"), encoding.alias("encoding"))

        of_all = F.struct(
            F.lit(-1).alias("fold"), merged_parts(F.col("parts"))[0].alias("n"),
            encoding_of(F.col("parts"), mean[-1], variance[-1]).alias("encoding"),
        )
        folds = F.filter("parts", lambda p: p["fold"] >= 0)
        entries = whole.select("column", "category", F.inline(F.concat(F.array(of_all), F.transform(folds, without))))
        table = durable(
            entries.select("column", encoding_key(F.col("fold"), F.col("category")).alias("_key"), "n", "encoding"), "encodings"
        )
        sizes = {r[0]: r[1] for r in table.groupBy("column").count().collect()}
        model = FoldTargetEncoderModel(
            folds=list(moments), means=[m for m, _ in moments.values()],
            sizes=[sizes.get(c, 0) for c in self.getInputCols()],
        )
        model.table = table
        return self._copyValues(model)


def encoding_key(fold: Column, category: Column) -> Column:
    return F.concat(fold.cast("string"), F.lit(":"), category)


def _other_moments(parts: dict[int, tuple[int, float, float]]) -> dict[int, tuple[float, float]]:
    """Mean and variance of the target: of all rows under -1, of the rows outside a fold under its number."""

    def merged(chosen):
        n = sum(p[0] for p in chosen)
        if n == 0:
            return 0.0, 0.0
        mean = sum(p[0] * p[1] for p in chosen) / n
        return mean, sum(p[0] * (p[2] + (p[1] - mean) ** 2) for p in chosen) / n

    out = {-1: merged(parts.values())}
    for fold in sorted(f for f in parts if f >= 0):
        out[fold] = merged([p for f, p in parts.items() if f != fold])
    return out


class TableWriter(MLWriter):
    """Saves a model whose learned state is a table, beside its parameters."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/encodings")


class TableReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.parquet(f"{path}/encodings")
        return model


class FoldTargetEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    """The encodings stay a table, one row per category and fold, however many there are."""

    folds = Param(Params._dummy(), "folds", "fold numbers, -1 for all rows", TypeConverters.toListInt)
    means = Param(Params._dummy(), "means", "target mean outside each fold", TypeConverters.toListFloat)
    sizes = Param(Params._dummy(), "sizes", "table rows per column", TypeConverters.toListInt)
    table: DataFrame

    @keyword_only
    def __init__(self, *, folds=None, means=None, sizes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fold_name = self.getOrDefault("foldCol")
        known = self.getOrDefault("folds")
        fold = F.lit(-1)
        if fold_name in dataset.columns:
            fold = F.when(F.col(fold_name).isin([f for f in known if f >= 0] or [-1]), F.col(fold_name).cast("int")).otherwise(-1)
        means = F.create_map(*[F.lit(v) for f, m in zip(known, self.getOrDefault("means")) for v in (f, m)])
        for (column, out), rows in zip(self._columns(), self.getOrDefault("sizes")):
            encodings = self.table.where(F.col("column") == column).select("_key", "n", "encoding")
            keyed = dataset.withColumn("_key", encoding_key(fold, known_category(column)))
            joined = lookup(keyed, encodings, "_key", "n", rows=rows)
            dataset = joined.withColumn(out, F.coalesce("encoding", means[fold])).drop("_key", "encoding")
        return dataset

    def write(self) -> MLWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls)


def feature_roles(df: DataFrame, label: str) -> tuple[list[str], list[str], list[str]]:
    """Numeric columns, text columns with few categories, text columns with many."""
    skip = (*NON_FEATURES, *INTERNAL, label)
    texts = text_columns(df, skip)
    return numeric_columns(df, skip), [c for c in texts if c not in HIGH_CARDINALITY], [c for c in HIGH_CARDINALITY if c in texts]


def preprocessor(df: DataFrame, label: str = "price_usd") -> Estimator:
    """Unfitted preprocessing for the columns of the frame it is fitted on; the vector column is ``features``.

    Block order and names: ``num__<column>``, ``cat_low__<column>_<value>``, ``cat_high__<column>``.
    """
    from tasador.operators.fold_statistics import Preprocessor  # which uses the stages of this module

    return Preprocessor(label)


def encode(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, "features")


def feature_names(encoded: DataFrame, column: str = "features") -> list[str]:
    """Names in vector order, from the column metadata; that of an empty category ends with the underscore. Vectors with many categories have no names there, but in a table."""
    groups = encoded.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return [a["name"].replace(MARK, "") for a in sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])]
