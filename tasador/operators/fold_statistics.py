"""Preprocessing for many training sets at once, from statistics that add up.

A training set is all rows but those of one outer fold (or all rows). What its preprocessing needs are counts, means and sums of squares, and those of a set are the sums over the folds it
holds. So rows are read three times, whatever the number of sets: once for the moments of numbers and target by fold, once (more for large data) for the medians of all sets together, once for
a table with one row per column, category and pair of folds. The number of jobs does not depend on the number of sets either.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import sqrt

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.text import MARK
from tasador.operators.encode import (
    INNER_FOLD, OUTER_FOLD, CategoryLabels, FoldTargetEncoderModel, ModeImputerModel, NumericBlockModel, encoding_key, encoding_of, feature_roles, known_category, merged_parts,
)
from tasador.operators.quantiles import exact_quantiles
from tasador.operators.wide_categories import NAMED, CategoryIndexModel, SparseAssembler, ranked_categories
from tasador.session import durable

#: The training set that leaves no fold out.
ALL = -1

Moments = tuple[int, float, float]


def merged(parts: Iterable[Moments]) -> Moments:
    """Number, mean and sum of squared deviations of all parts together."""
    parts = [p for p in parts if p[0]]
    n = sum(p[0] for p in parts)
    if not n:
        return 0, 0.0, 0.0
    mean = sum(p[0] * p[1] for p in parts) / n
    return n, mean, sum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts)


def scale_of(present: Moments, missing: int, median: float) -> tuple[float, float]:
    """Mean and population deviation once the missing values are the median; a constant column has scale 1."""
    n, mean, squares = merged([present, (missing, median, 0.0)])
    deviation = sqrt(squares / n) if n else 0.0
    return mean, deviation if deviation > 1e-12 * max(abs(mean), abs(median), present[1] and abs(present[1])) else 1.0


def moments_by_fold(rows: DataFrame, numbers: Sequence[str], label: str) -> dict[tuple[int, int], tuple[int, dict[str, Moments]]]:
    """Rows, and moments of the label and of every number, for each pair of outer and inner fold; one pass."""
    columns = [label, *numbers]
    values = [F.col(c).cast("double") for c in columns]
    found = rows.groupBy("_outer", "_inner").agg(F.count(F.lit(1)), *[f(v) for v in values for f in (F.count, F.avg, F.var_pop)]).collect()  # a row for each pair of folds
    return {
        (r[0], r[1]): (r[2], {c: (r[3 + 3 * i], r[4 + 3 * i] or 0.0, r[3 + 3 * i] * (r[5 + 3 * i] or 0.0)) for i, c in enumerate(columns)}) for r in found
    }


def category_parts(rows: DataFrame, columns: Sequence[str], high: Sequence[str], label: str) -> DataFrame:
    """rows, and n, mean and m2 of the label, by column, category, outer and inner fold: one pass, combined before the shuffle; stored.

    Missing values are a category of the columns ``high`` and none of the others.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), (known_category(c) if c in high else F.col(c).cast("string")).alias("category")) for c in columns])
    y = F.col(label).cast("double")
    long = rows.select(F.col("_outer").alias("outer"), F.col("_inner").alias("inner"), y.alias("y"), F.inline(pairs)).where(F.col("category").isNotNull())
    parts = long.groupBy("column", "category", "outer", "inner").agg(
        F.count(F.lit(1)).alias("rows"), F.count("y").alias("n"), F.coalesce(F.avg("y"), F.lit(0.0)).alias("mean"), F.coalesce(F.count("y") * F.var_pop("y"), F.lit(0.0)).alias("m2")
    )
    return durable(parts, "parts")


def _outside(k: int, fold: Column) -> Column:
    return F.lit(True) if k == ALL else fold != k


def category_counts(parts: DataFrame, columns: Sequence[str], sets: Sequence[int]) -> DataFrame:
    """Rows of each (column, category) in each training set, as n0, n1, ... in the order of ``sets``; stored."""
    counts = [F.coalesce(F.sum(F.when(_outside(k, F.col("outer")), F.col("rows"))), F.lit(0)).alias(f"n{i}") for i, k in enumerate(sets)]
    return durable(parts.where(F.col("column").isin(*columns)).groupBy("column", "category").agg(*counts), "counts")


def modes_of(counts: DataFrame, columns: Sequence[str], sets: Sequence[int]) -> dict[int, dict[str, str]]:
    """Most frequent category by set and column, the smallest one on a tie, the empty text for a column without any."""
    best = [F.min(F.when(F.col(f"n{i}") > 0, F.struct((-F.col(f"n{i}")).alias("minus"), "category"))).alias(f"b{i}") for i in range(len(sets))]
    found = {r["column"]: r for r in counts.groupBy("column").agg(*best).collect()}  # a row for each column
    pick = lambda c, i: found[c][f"b{i}"]["category"] if c in found and found[c][f"b{i}"] else ""
    return {k: {c: pick(c, i) for c in columns} for i, k in enumerate(sets)}


def labels_of(counts: DataFrame, columns: Sequence[str], sets: Sequence[int]) -> dict[int, dict[str, list[str]]]:
    """Categories by set and column, in their order, for columns with few categories."""
    named = F.when(F.col("category") == "", F.lit(MARK)).otherwise(F.col("category"))
    rows = counts.select("column", named.alias("category"), *[f"n{i}" for i in range(len(sets))]).orderBy("category").collect()
    out = {k: {c: [r["category"] for r in rows if r["column"] == c and r[f"n{i}"] > 0] for c in columns} for i, k in enumerate(sets)}
    return {k: {c: found or [MARK] for c, found in by_column.items()} for k, by_column in out.items()}


def encoder_models(
    parts: DataFrame, high: Sequence[str], label_moments: dict[tuple[int, int], Moments], sets: Sequence[int], label: str
) -> dict[int, FoldTargetEncoderModel]:
    """Target encoders of all sets from one table of encodings: by set, inner fold that is hidden (-1: none), column and category."""
    inner = sorted({f for _, f in label_moments if f >= 0})
    overall = {}
    for k in sets:
        for f in (-1, *inner):
            n, mean, squares = merged(m for (o, i), m in label_moments.items() if (k == ALL or o != k) and (f < 0 or i != f))
            overall[k, f] = mean, squares / n if n else 0.0
    cases = F.array(*[F.struct(F.lit(k).alias("set"), F.lit(f).alias("hidden"), F.lit(m).alias("all_mean"), F.lit(v).alias("all_variance")) for (k, f), (m, v) in overall.items()])
    whole = parts.where(F.col("column").isin(*high) & (F.col("n") > 0)).groupBy("column", "category").agg(F.sort_array(F.collect_list(F.struct("outer", "inner", "n", "mean", "m2"))).alias("parts"))
    every = whole.select("column", "category", "parts", F.inline(cases))
    inside = lambda q: (F.col("set") == ALL) | (q["outer"] != F.col("set"))
    own = F.filter("parts", lambda q: inside(q) & ((F.col("hidden") < 0) | (q["inner"] == F.col("hidden"))))
    others = F.filter("parts", lambda q: inside(q) & ((F.col("hidden") < 0) | (q["inner"] != F.col("hidden"))))
    entries = every.select(
        "set", "column", encoding_key(F.col("hidden"), F.col("category")).alias("_key"), merged_parts(own)[0].alias("n"),
        encoding_of(others, F.col("all_mean"), F.col("all_variance")).alias("encoding"),
    )
    table = durable(entries.where("n > 0"), "encodings")
    sizes = {(r[0], r[1]): r[2] for r in table.groupBy("set", "column").count().collect()}  # a row for each set and column
    models = {}
    for k in sets:
        model = FoldTargetEncoderModel(folds=[-1, *inner], means=[overall[k, f][0] for f in (-1, *inner)], sizes=[sizes.get((k, c), 0) for c in high])
        model.table = table.where(F.col("set") == k).drop("set")
        models[k] = model._set(inputCols=list(high), outputCols=[f"cat_high__{c}" for c in high], labelCol=label)
    return models


def learn_sets(rows: DataFrame, label: str, sets: Sequence[int] = (ALL,)) -> dict[int, PipelineModel]:
    """Fitted preprocessing of each training set: all rows but those whose OUTER_FOLD is its number, or all.

    Rows whose INNER_FOLD is present are encoded without their own inner fold. Block order and names are those of :func:`preprocessor`. Once a column has more than NAMED categories, its
    dictionary stays a table, places in the vector are those in all rows, and the names of the features are a table as well (:func:`wide_categories.feature_table`).
    """
    numbers, low, high = feature_roles(rows, label)
    fold = lambda name: F.coalesce(F.col(name).cast("int"), F.lit(-1)) if name in rows.columns else F.lit(-1)
    marked = rows.select(label, *numbers, *low, *high, fold(OUTER_FOLD).alias("_outer"), fold(INNER_FOLD).alias("_inner"))
    found = moments_by_fold(marked, numbers, label)
    stages: dict[int, list] = {k: [] for k in sets}
    outputs: dict[int, list[str]] = {k: [] for k in sets}
    widths: dict[int, dict[str, int]] = {k: {} for k in sets}
    if numbers:
        inside = {k: [v for (o, _), v in found.items() if k == ALL or o != k] for k in sets}
        present = {(k, c): merged(m[c] for _, m in inside[k]) for k in sets for c in numbers}
        values = marked.select(*[F.when(_outside(k, F.col("_outer")), F.col(c)).alias(f"v{i}_{j}") for i, k in enumerate(sets) for j, c in enumerate(numbers)])
        names = {f"v{i}_{j}": (k, c) for i, k in enumerate(sets) for j, c in enumerate(numbers)}
        quantiles = exact_quantiles(values, {n: (0.5,) for n in names}, sizes=[present[key][0] for key in names.values()])
        medians = {key: 0.0 if quantiles[n][0] is None else float(quantiles[n][0]) for n, key in names.items()}
        for k in sets:
            total = sum(n for n, _ in inside[k])
            scales = [scale_of(present[k, c], total - present[k, c][0], medians[k, c]) for c in numbers]
            outs = [f"num__{c}" for c in numbers]
            model = NumericBlockModel(medians=[medians[k, c] for c in numbers], means=[m for m, _ in scales], scales=[s for _, s in scales])
            stages[k].append(model._set(inputCols=numbers, outputCols=outs))
            outputs[k] += outs
    if low or high:
        parts = category_parts(marked, [*low, *high], high, label)
    if low:
        counts = category_counts(parts, low, sets)
        sizes = {r[0]: r[1] for r in counts.groupBy("column").count().collect()}  # a row for each column
        wide = [c for c in low if sizes.get(c, 0) > NAMED]
        few = [c for c in low if c not in wide]
        modes, labels = modes_of(counts, low, sets), labels_of(counts.where(~F.col("column").isin(*wide)) if wide else counts, few, sets)
        ranked = ranked_categories(counts, wide) if wide else None
        filled, named, index, outs = ({c: f"{p}{c}" for c in low} for p in ("_filled_", "_label_", "_index_", "cat_low__"))
        for i, k in enumerate(sets):
            stages[k].append(ModeImputerModel(modes=[modes[k][c] for c in low])._set(inputCols=low, outputCols=[filled[c] for c in low]))
            indexers = [StringIndexerModel.from_labels(labels[k][c], named[c], index[c], "keep") for c in few]
            if few:
                stages[k] += [CategoryLabels(inputCols=[filled[c] for c in few], outputCols=[named[c] for c in few]), *indexers]
            if wide:
                table = ranked.where(F.col(f"n{i}") > 0).select(F.concat(F.lit("_filled_"), "column").alias("column"), "category", F.col(f"n{i}").alias("n"), "index")
                model = CategoryIndexModel(inputCols=[filled[c] for c in wide], outputCols=[index[c] for c in wide], sizes=[sizes[c] for c in wide])
                model.table = table
                stages[k].append(model)
                outputs[k] += [index[c] for c in low]
                widths[k].update({index[c]: sizes[c] if c in wide else len(labels[k][c]) for c in low})
            else:
                one_row = rows.sparkSession.createDataFrame([tuple("" for _ in low)], ", ".join(f"`{named[c]}` string" for c in low))
                encoder = OneHotEncoder(inputCols=[index[c] for c in low], outputCols=[outs[c] for c in low], dropLast=True)
                stages[k].append(encoder.fit(PipelineModel(stages=indexers).transform(one_row)))  # sizes come from the labels, no job is run
                outputs[k] += [outs[c] for c in low]
    if high:
        for k, model in encoder_models(parts, high, {f: m[label] for f, (_, m) in found.items()}, sets, label).items():
            stages[k].append(model)
            outputs[k] += model.getOutputCols()
    assembler = lambda k: SparseAssembler(inputCols=outputs[k], outputCol="features", sizes=[widths[k].get(c, 0) for c in outputs[k]]) if widths[k] else VectorAssembler(inputCols=outputs[k], outputCol="features")
    return {k: PipelineModel(stages=[*stages[k], assembler(k)]) for k in sets}


class Preprocessor(Estimator):
    """Unfitted preprocessing of the columns that a frame has; ``features`` is the vector column."""

    def __init__(self, label: str):
        super().__init__()
        self.label = label

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return learn_sets(dataset.drop(OUTER_FOLD), self.label)[ALL]
