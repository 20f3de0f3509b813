"""Exact quantiles by linear interpolation whose state stays bounded at any data size.

``percentile`` keeps one entry per distinct value in a single task. It is used only up to
``EXACT_ROWS`` rows. Beyond that the wanted ranks are bracketed: a bounded sketch proposes
cut points, one aggregate counts the rows around them exactly, and the bracket shrinks about
a hundredfold per round until the rank falls on a cut point or few rows are left to sort.
Values that repeat often are cut points themselves, so skew ends the search early.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.operators.lookup import BROADCAST_ROWS, HOT_SHARES, small_enough
from tasador.session import durable

EXACT_ROWS = 250_000
CUTS = 200
ACCURACY = 10_000
GRID = [i / CUTS for i in range(CUTS + 1)]


def _ranks(p: float, n: int) -> tuple[int, int, float]:
    position = p * (n - 1)
    low = int(position)
    return low, min(low + 1, n - 1), position


def _blend(low_value: float, high_value: float, low: int, position: float) -> float:
    if position == low:
        return low_value
    return (low + 1 - position) * low_value + (position - low) * high_value


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], exact_rows: int = EXACT_ROWS, sizes: Sequence[int] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns. Only scalars reach the driver; missing values are left out.

    ``sizes`` has the present values of each column if they have been counted before, for a frame that is cheap to read again: it is not kept then, and columns of few rows take one pass.
    """
    names = list(wanted)
    values = df.select(
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)]
    )
    cached = df.is_cached or sizes is not None
    if not cached:
        values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if sizes is None:
            sizes = values.agg(*[F.count(c) for c in values.columns]).first()
        found: dict[str, list[float | None]] = {c: [None] * len(wanted[c]) for c in names}
        small = [i for i in range(len(names)) if 0 < sizes[i] <= exact_rows]
        if small:
            row = values.agg(
                *[F.percentile(f"v{i}", F.array(*[F.lit(float(p)) for p in wanted[names[i]]])) for i in small]
            ).first()
            found.update({names[i]: list(row[k]) for k, i in enumerate(small)})
        large = [i for i in range(len(names)) if sizes[i] > exact_rows]
        if large:
            ranks = {
                (i, r) for i in large for p in wanted[names[i]] for r in _ranks(p, sizes[i])[:2]
            }
            value_at = _select_ranks(values, ranks, sizes, exact_rows)
            for i in large:
                out = []
                for p in wanted[names[i]]:
                    low, high, position = _ranks(p, sizes[i])
                    out.append(_blend(value_at[i, low], value_at[i, high], low, position))
                found[names[i]] = out
        return found
    finally:
        if not cached:
            values.unpersist()


def _inside(value: Column, low: float | None, high: float | None) -> Column:
    test = value.isNotNull()
    if low is not None:
        test = test & (value > low)
    if high is not None:
        test = test & (value < high)
    return test


def _cut_pair(cuts: Sequence[float], rank: int, size: int) -> tuple[float, float]:
    step = rank * CUTS // size
    return cuts[max(step - 1, 0)], cuts[min(step + 2, CUTS)]


def _select_ranks(values: DataFrame, ranks: set[tuple[int, int]], sizes, exact_rows: int) -> dict:
    """Value at each (column, rank); a bracket is (low, high, rows below it, rows inside), bounds exclusive."""
    done: dict[tuple[int, int], float] = {}
    open_ = {key: (None, None, 0, sizes[key[0]]) for key in ranks}
    while True:
        wide = {k: b for k, b in open_.items() if b[3] > exact_rows}
        if not wide:
            break
        spans = list({(k[0], b[0], b[1]) for k, b in wide.items()})
        row = values.agg(
            *[
                F.percentile_approx(F.when(_inside(F.col(f"v{i}"), lo, hi), F.col(f"v{i}")), GRID, ACCURACY)
                for i, lo, hi in spans
            ]
        ).first()
        cuts = {span: row[k] for k, span in enumerate(spans)}
        pairs = {k: _cut_pair(cuts[k[0], b[0], b[1]], k[1] - b[2], b[3]) for k, b in wide.items()}
        tests = []
        for k, (lo, hi, _, _) in wide.items():
            v, (a, b) = F.col(f"v{k[0]}"), pairs[k]
            inside = _inside(v, lo, hi)
            tests += [F.count_if(inside & (v < a)), F.count_if(v == a), F.count_if((v > a) & (v < b)), F.count_if(v == b)]
        counts = values.agg(*[t.alias(f"n{j}") for j, t in enumerate(tests)]).first()
        for j, (k, (lo, hi, below, size)) in enumerate(wide.items()):
            a, b = pairs[k]
            under, at_a, between, at_b = counts[4 * j : 4 * j + 4]
            rank = k[1] - below
            if rank < under:
                open_[k] = (lo, a, below, under)
            elif rank < under + at_a:
                done[k] = a
            elif rank < under + at_a + between:
                open_[k] = (a, b, below + under + at_a, between)
            elif a != b and rank < under + at_a + between + at_b:
                done[k] = b
            else:
                skipped = under + at_a + between + (at_b if a != b else 0)
                open_[k] = (b, hi, below + skipped, size - skipped)
            if k in done:
                del open_[k]
    if open_:
        items = list(open_.items())
        row = values.agg(
            *[
                F.sort_array(F.collect_list(F.when(_inside(F.col(f"v{k[0]}"), b[0], b[1]), F.col(f"v{k[0]}"))))[
                    k[1] - b[2]
                ].alias(f"x{j}")
                for j, (k, b) in enumerate(items)
            ]
        ).first()
        done.update({k: row[j] for j, (k, _) in enumerate(items)})
    return done


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], exact_rows: int = EXACT_ROWS,
    sizes: DataFrame | None = None, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per group: ``keys`` and ``quantiles``, an array in the order of ``probs``.

    ``sizes`` has the present values per group, as ``size``, if they have been counted before. While every group is small this is one aggregate. As soon as one group is not, all groups
    go through the bracketing, with the brackets kept in a table and never on the driver.
    """
    if not keys:
        raise ValueError("no keys: use exact_quantiles for whole columns")
    column = F.col(value).cast("double")
    pairs = df.select(*keys, column.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if sizes is None:
        sizes = pairs.groupBy(*keys).agg(F.count("v").alias("size"))
    sizes = sizes.where("size > 0")
    peak = sizes.agg(F.max("size")).first()[0]
    if peak is None or peak <= exact_rows:
        return pairs.groupBy(*keys).agg(F.percentile("v", F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles"))
    pairs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _bracket_groups(pairs, sizes, list(keys), probs, exact_rows, broadcast_rows)
    finally:
        pairs.unpersist()


def _join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], weight: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Null-safe join of the rows with a table that has few rows per group.

    A small table is broadcast. Of a large one only the groups are whose ``weight`` is at least a thousandth of the whole (a thousand groups at most); their rows are
    served where they are, and only the others are shuffled, so that no hot group meets in one task.
    """
    groups = groups.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    names = [f"_{k}" for k in keys]
    if small_enough(groups, broadcast_rows):
        return rows.join(F.broadcast(groups), same, "inner").drop(*names)
    if weight is None:
        return rows.join(groups, same, "inner").drop(*names)
    by_group = groups.groupBy(*names).agg(F.max(weight).alias("_weight"))
    total = by_group.agg(F.sum("_weight")).first()[0] or 0
    hot_keys = by_group.where(F.col("_weight") * HOT_SHARES >= total).drop("_weight")
    again = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    hot = groups.join(F.broadcast(hot_keys.withColumnsRenamed({n: f"_{n}" for n in names})), again, "inner").drop(*[f"_{n}" for n in names])
    served = rows.join(F.broadcast(hot), same, "inner").drop(*names)
    shuffled = rows.join(F.broadcast(hot_keys), same, "left_anti").join(groups, same, "inner").drop(*names)
    return served.unionByName(shuffled)


def _in_bracket() -> Column:
    above = F.col("low").isNull() | (F.col("v") > F.col("low"))
    under = F.col("high").isNull() | (F.col("v") < F.col("high"))
    return above & under


def _bracket_groups(pairs: DataFrame, sizes: DataFrame, keys: list[str], probs, exact_rows: int, broadcast_rows: int) -> DataFrame:
    position = [F.lit(float(p)) * (F.col("size") - 1) for p in probs]
    ranks = F.array(*[r for x in position for r in (F.floor(x), F.ceil(x))])
    state = durable(
        sizes.select(
            *keys,
            F.explode(F.array_distinct(ranks)).alias("rank"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.lit(0).cast("bigint").alias("below"),
            F.col("size").alias("inside"),
            F.lit(None).cast("double").alias("found"),
        ),
        "brackets",
    )
    group = [*keys, "rank"]
    while True:
        wide = state.where(F.col("found").isNull() & (F.col("inside") > exact_rows))
        if wide.isEmpty():
            break
        cuts = (
            _join_groups(pairs, wide, keys, "inside", broadcast_rows).where(_in_bracket())
            .groupBy(*group, "low", "high", "below", "inside")
            .agg(F.percentile_approx("v", GRID, ACCURACY).alias("cuts"))
        )
        step = F.floor((F.col("rank") - F.col("below")) * CUTS / F.col("inside")).cast("int")
        cuts = durable(
            cuts.withColumn("a", F.get("cuts", F.greatest(step - 1, F.lit(0))))
            .withColumn("b", F.get("cuts", F.least(step + 2, F.lit(CUTS))))
            .drop("cuts"),
            "cuts",
        )
        v, a, b = F.col("v"), F.col("a"), F.col("b")
        counted = (
            _join_groups(pairs, cuts, keys, "inside", broadcast_rows).where(_in_bracket())
            .groupBy(*group, "low", "high", "below", "inside", "a", "b")
            .agg(
                F.count_if(v < a).alias("under"),
                F.count_if(v == a).alias("at_a"),
                F.count_if((v > a) & (v < b)).alias("between"),
                F.when(a != b, F.count_if(v == b)).otherwise(F.lit(0)).alias("at_b"),
            )
        )
        rank = F.col("rank") - F.col("below")
        under, at_a, between, at_b = (F.col(c) for c in ("under", "at_a", "between", "at_b"))
        place = (
            F.when(rank < under, 0).when(rank < under + at_a, 1).when(rank < under + at_a + between, 2)
            .when(rank < under + at_a + between + at_b, 3).otherwise(4)
        )
        p = F.col("place")
        moved = counted.withColumn("place", place).select(
            *group,
            F.when(p == 2, a).when(p == 4, b).otherwise(F.col("low")).alias("low"),
            F.when(p == 0, a).when(p == 2, b).otherwise(F.col("high")).alias("high"),
            (F.col("below") + F.when(p == 2, under + at_a).when(p == 4, under + at_a + between + at_b).otherwise(0)).alias("below"),
            F.when(p == 0, under).when(p == 2, between).otherwise(F.col("inside") - under - at_a - between - at_b).alias("inside"),
            F.when(p == 1, a).when(p == 3, b).alias("found"),
        )
        settled = state.where(F.col("found").isNotNull() | (F.col("inside") <= exact_rows))
        state = durable(settled.unionByName(moved), "brackets")
    few = state.where(F.col("found").isNull())
    picked = (
        _join_groups(pairs, few, keys, "inside", broadcast_rows).where(_in_bracket())
        .groupBy(*group, "below")
        .agg(F.sort_array(F.collect_list("v")).alias("sorted"))
        .select(*group, F.get("sorted", (F.col("rank") - F.col("below")).cast("int")).alias("found"))
    )
    known = state.where(F.col("found").isNotNull()).select(*group, "found").unionByName(picked)
    at = known.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "found"))).alias("at"))
    at = _join_groups(at, sizes, keys)
    quantiles = [
        F.when(F.floor(x) == F.ceil(x), F.col("at")[F.floor(x)]).otherwise(
            (F.ceil(x) - x) * F.col("at")[F.floor(x)] + (x - F.floor(x)) * F.col("at")[F.ceil(x)]
        )
        for x in position
    ]
    return durable(at.select(*keys, F.array(*quantiles).alias("quantiles")), "quantiles")
