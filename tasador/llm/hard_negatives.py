"""Hard negatives for anchors, by exact integer scores from a residue number system.

Components become whole numbers. A block of anchors and a block of rows are multiplied modulo several small primes: residues lie around zero, so every sum of products stays below
2 ** 24 and float32 matrix products, the fastest there are, are exact. How many primes a pair of blocks needs follows from the lengths of its vectors (no score exceeds the product of
two lengths). Chinese remaindering turns the residues into the exact signed scores, however large they are.

First the positives of each anchor are chosen, then its negatives inside the window of scores below each positive. Both times all rows meet all anchors in bounded blocks: rows are
shuffled once for each tile of anchors, anchors once for each block of rows, only the best of each block leave it, and a window over anchors merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored

SCALE, EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 256, 100, 5, 5, 80, 100
#: Most anchors of a tile and rows of a block, least rows of a block, blocks aimed at, most bytes of a block of vectors.
ANCHORS, ROWS, LEAST_ROWS, BLOCKS, BYTES = 32_768, 65_536, 2_048, 64, 64 << 20
#: Anchors whose scores are computed at once against a block of rows: entries of the score matrix.
CELLS = 2 << 20
#: Components whose products are added up before the sums are reduced again.
DEPTH = 256
#: Scores beyond this count as this, so that they fit the result; from a length of 2 ** 30 on a vector is wide, and only scores of wide vectors can get there.
MOST, WIDE = 1 << 60, 30


def primes(depth: int) -> Iterator[int]:
    """Falling primes whose residues around zero keep ``depth`` products below 2 ** 24."""
    n = 2 * math.isqrt(((1 << 24) - 1) // depth) + 1
    while n > 2:
        if all(n % d for d in range(2, math.isqrt(n) + 1)):
            yield n
        n -= 1


def bits(x: np.ndarray) -> float:
    """An upper bound on log2 of the length of the longest row of whole components."""
    top = float(np.abs(x).max(initial=0.0))
    if top < 2.0**500:  # squares do not overflow
        return 0.5 * math.log2(float(((np.abs(x) * SCALE + 1) ** 2).sum(1).max(initial=1.0))) + 1e-6
    return math.log2(top) + math.log2(SCALE) + 0.5 * math.log2(x.shape[1]) + 1


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """floor(SCALE * x) modulo p, around zero, exact for every finite double."""
    whole = np.where(np.abs(x) < 2.0**52, np.floor(SCALE * np.clip(x, -(2.0**52), 2.0**52)), np.fmod(x, p) * SCALE)
    r = np.fmod(whole, p)
    return (r - p * np.rint(r / p)).astype(np.float32)


def product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Residues of a @ b.T from 0 to p - 1; every partial sum is exact in float32."""
    total = np.zeros((len(a), len(b)), np.int32)
    for k in range(0, a.shape[1], DEPTH):
        total += (a[:, k : k + DEPTH] @ b[:, k : k + DEPTH].T).astype(np.int32) % p
    return total % p if a.shape[1] > DEPTH else total


def moduli(need: float, depth: int) -> list[int]:
    """As many primes as it takes for signed numbers up to 2 ** need."""
    out, have = [], 0.0
    for p in primes(min(max(depth, 1), DEPTH)):
        out.append(p)
        have += math.log2(p)
        if have > need + 1.001:
            return out
    raise ValueError("not enough primes")


def remaindered(parts: list[np.ndarray], ps: list[int]) -> np.ndarray:
    """The signed numbers with these residues, by mixed radix digits; beyond MOST they count as MOST."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(ps):
        rest, radix = parts[i].astype(np.int64), 1
        for d, q in zip(digits, ps):
            rest = (rest - d * radix) % p
            radix = radix * q % p
        digits.append(rest * pow(radix, -1, p) % p)
    span = math.prod(ps)
    kind = np.int64 if span < 1 << 62 else object
    value = np.zeros(parts[0].shape, kind)
    for d, q in zip(digits[::-1], ps[::-1]):
        value = value * q + d.astype(kind)
    value = np.where(value > span // 2, value - span, value)
    return np.clip(value, -MOST, MOST).astype(np.int64)


def block_scores(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Exact scores of some anchors at a time against all rows of a block: number of the first anchor, scores."""
    if not len(a) or not len(b):
        return
    ps = moduli(bits(a) + bits(b), a.shape[1])
    own = [residues(b, p) for p in ps]
    step = max(1, CELLS // len(b))
    for i in range(0, len(a), step):
        yield i, remaindered([product(residues(a[i : i + step], p), r, p) for p, r in zip(ps, own)], ps)


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest allowed scores, largest first, ties by place."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        s = score[at]
        at = at[s >= np.partition(s, -k)[-k]]
    return at[np.argsort(-score[at], kind="stable")][:k]


POSITIVE = "anchor long, anchor_id long, positive_id long, positive_row long, score long"


def _positives(k: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        ids, row, label = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        own, anchor_ids, anchor_labels = (anchors.column(c).to_numpy() for c in ("anchor", "anchor_id", "anchor_label"))
        out = []
        for first, scores in block_scores(_matrix(anchors, "anchor_vector"), _matrix(rows, "vector")):
            for i, score in enumerate(scores, first):
                at = best(score, (label == anchor_labels[i]) & (ids != anchor_ids[i]), k)
                out.append((np.full(len(at), own[i]), np.full(len(at), anchor_ids[i]), ids[at], row[at], score[at]))
        names = [c.split()[0] for c in POSITIVE.split(", ")]
        return pa.table({n: pa.array(np.concatenate(x) if out else [], pa.int64()) for n, x in zip(names, zip(*out) if out else [[]] * 5)})

    return run


NEGATIVE = "anchor long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_row long, negative_score long"


def _negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        ids, row, label = (rows.column(c).to_numpy() for c in ("vec_id", "row", "label"))
        own, anchor_ids, anchor_labels = (anchors.column(c).to_numpy() for c in ("anchor", "anchor_id", "anchor_label"))
        positives, out = anchors.column("positives").to_pylist(), []
        for first, scores in block_scores(_matrix(anchors, "anchor_vector"), _matrix(rows, "vector")):
            for i, score in enumerate(scores, first):
                windows = [(p, -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives[i]]
                at = np.flatnonzero((label != anchor_labels[i]) & (ids != anchor_ids[i]) & (score >= min(w[1] for w in windows)))
                at = at[np.argsort(-score[at], kind="stable")]
                falling = -score[at]
                for p, least, most in windows:
                    some = at[np.searchsorted(falling, -most) :][:k]
                    some = some[score[some] >= least]
                    n = len(some)
                    out.append(([own[i]] * n, [anchor_ids[i]] * n, [p["place"]] * n, [p["positive_id"]] * n, [p["score"]] * n, ids[some].tolist(), row[some].tolist(), score[some].tolist()))
        names = [c.split() for c in NEGATIVE.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32()}
        return pa.table({n: pa.array([v for part in x for v in part], kinds[t]) for (n, t), x in zip(names, zip(*out) if out else [[]] * 8)})

    return run


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector (doubles), wide and a number ``row`` that no other row has, of the rows that take part; stored.

    Left out: null ids, labels and vectors, empty vectors, those with a null or non-finite component, and those whose size is not the most frequent one (of equally frequent ones the largest).
    """
    x = F.col("vector")
    rows = columns(embeddings, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & fine)
    largest = F.array_max(F.transform(x, lambda v: F.abs(v))) * F.sqrt(F.size(x).cast("double"))
    rows = stored(rows.withColumn("wide", largest >= float(1 << WIDE) / SCALE).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size(x).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size(x) == F.lit(sizes.size if sizes else 0))


def _dealt(number: Column, wide: Column, name: str, counts: dict[bool, int], each: int) -> tuple[Column, int]:
    """A group for each row by ``number``, at most about ``each`` rows in one, wide rows in groups of their own; and how many groups there are."""
    plain, apart = (-(-counts.get(w, 0) // each) for w in (False, True))
    spread = lambda n: F.pmod(F.xxhash64(number), F.lit(max(n, 1))).cast("int")
    return F.when(wide, spread(apart) + plain).otherwise(spread(plain)).alias(name), plain + apart


def _meet(anchors: DataFrame, rows: DataFrame, run, schema: str) -> DataFrame:
    """All anchors against all rows in bounded groups: ``anchors`` in tiles, ``rows`` in blocks."""
    size = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    total, asked = (dict(df.groupBy(c).count().collect()) for df, c in ((rows, "wide"), (anchors, "anchor_wide")))  # one or two numbers
    some = max(1, BYTES // (8 * size))
    block, blocks = _dealt(F.col("row"), F.col("wide"), "block", total, min(ROWS, some, max(LEAST_ROWS, -(-sum(total.values()) // BLOCKS))))
    tile, tiles = _dealt(F.col("anchor"), F.col("anchor_wide"), "tile", asked, min(ANCHORS, some))
    every = lambda number: F.explode(F.sequence(F.lit(0), F.lit(max(number, 1) - 1)))
    left = anchors.select("*", tile).withColumn("block", every(blocks))
    right = rows.select("*", block).withColumn("tile", every(tiles))
    return left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInArrow(run, schema)


def hard_negatives(
    embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor, anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components x count as floor(256 * x); a score is the inner product with the anchor. Anchors are the rows whose vec_id is divisible by ``every``. The positives of an anchor are the
    ``positives`` other rows of its label with the highest scores (ties by smaller vec_id; all, if fewer). For each of them the ``negatives`` rows of another label with the highest
    scores are returned whose score is at least ``low`` and at most ``high`` hundredths of the positive's.

    Rows that take no part: see :func:`usable`. Two rows of one vec_id are two rows, each an anchor of its own if its id is divisible (``anchor`` tells their lists apart), but neither
    is the other's positive or negative. Scores beyond 2 ** 60 either way count as that; all smaller ones are exact. An empty table, or one without anchors, gives no rows. Other columns
    are ignored.
    """
    rows = usable(embeddings)
    asks = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("vector").alias("anchor_vector"), F.col("wide").alias("anchor_wide")
    )
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive_row"))
    found = _meet(asks, rows, _positives(positives), POSITIVE).withColumn("place", place).where(F.col("place") <= positives)
    chosen = stored(found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives")), "positives")
    windowed = _meet(asks.join(chosen, "anchor"), rows, _negatives(negatives, low, high), NEGATIVE)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_row"))
    ranked = windowed.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.select("anchor", "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
