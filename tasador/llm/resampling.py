"""Documents resampled towards a target collection, by hashed n-gram weights and a parallel sort.

Features are runs of words, hashed into buckets. The log ratio of a bucket's share in the target to its share in the documents is its gain; the gains are one array that every task
holds, and a document's weight is the sum over its features. Gumbel noise from a hash of the document's id turns "the largest scores" into a draw without replacement whose chances
follow the weights.

Ranks come from a parallel sort by regular sampling: every run (what one task reads) is sorted where it lies and sends rows at regular places; the sorted samples give regular
splitters; segments between splitters are exchanged, each is merged in one task, and the counts of the segments before it turn places into exact ranks. Segments that begin after the
last row drawn are not exchanged at all.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasador.llm.scratch import columns, stored
from tasador.llm.text import LOWER, NOT_WORD, pieces, spans, utf8

BUCKETS, RUN_WORDS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Rows aimed at in a segment, and the most segments: the splitters are held by the driver and by every task.
ROWS, SEGMENTS = 16_384, 2_000
#: Longest range whose checksum is computed for all ranges at once, byte by byte; longer ones are rare and computed one by one.
SHORT = 48
ORDER = ["low", "id", "n_features", "row"]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def crc_feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after one more byte range each; the first register is all ones, the checksum its complement."""
    state, size = state.copy(), ends - starts
    active, at = np.flatnonzero((size > 0) & (size <= SHORT)), 0
    while len(active):
        s = state[active]
        state[active] = CRC[(s ^ data[starts[active] + at]) & 255] ^ (s >> 8)
        at += 1
        active = active[size[active] > at]
    for i in np.flatnonzero(size > SHORT).tolist():
        state[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def feature_buckets(column: pa.Array, run_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of a text column, and the number of words of each row."""
    data, bounds = utf8(column)
    data = LOWER[data]
    starts, ends, rows = spans(~NOT_WORD[data[: bounds[-1]]], bounds)
    n, space = len(starts), np.array([32], np.uint8)
    state, found, of = np.full(n, 0xFFFFFFFF, np.uint32), [], []
    for k in range(min(run_words, n)):
        here = np.flatnonzero(rows[k:] == rows[: n - k])  # runs of k + 1 words that stay within a row
        state = state[here]
        if k:
            state = crc_feed(state, space, np.zeros(len(here), np.int64), np.ones(len(here), np.int64))
        state = crc_feed(state, data, starts[here + k], ends[here + k])
        found.append((~state).astype(np.int64) % buckets)
        of.append(rows[here])
        full = np.zeros(n, np.uint32)
        full[here] = state
        state = full[: n - k - 1]
    words = np.bincount(rows, minlength=len(bounds) - 1)
    return (np.concatenate(found), np.concatenate(of), words) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), words)


def bucket_counts(texts: DataFrame, run_words: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket. Each task sends one number for each bucket, whatever its rows; the driver gets one for each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for piece in pieces(batches):
            total += np.bincount(feature_buckets(piece.column("text"), run_words, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for r in columns(texts, "text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(target: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A thousandth-nat gain of each bucket, rounded down: the log of its share in the target, one feature added to each bucket, to that in the documents."""
    size, t_all, s_all = len(own), float(target.sum()), float(own.sum())
    ratio = ((target + 1.0) * (s_all + size)) / ((own + 1.0) * (t_all + size))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of a hash of the id (null: the text ``null``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def scores(documents: DataFrame, target: DataFrame, run_words: int = RUN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, key (a hash of the text), n_words, n_features, weight and score of every document, and a number ``row`` that no other row has; stored.

    Two passes over the documents, one over the target. A null text has no words; a document without features has weight 0.
    """
    gain = gains(bucket_counts(target, run_words, buckets), bucket_counts(documents, run_words, buckets))

    def run(batches):
        for piece in pieces(batches):
            bucket, of, words = feature_buckets(piece.column("text"), run_words, buckets)
            count = np.bincount(of, minlength=piece.num_rows)
            weight = np.bincount(of, gain[bucket], piece.num_rows)  # whole numbers far below 2 ** 53
            arrays = [piece.column("doc_id"), piece.column("key"), *[pa.array(x.astype(np.int64)) for x in (words, count, weight)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n_words", "n_features", "weight"])

    docs = columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    weighed = docs.mapInArrow(run, "doc_id long, key long, n_words long, n_features long, weight long")
    return stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id()), "scores")


def _segments(splitters: np.ndarray):
    """The segment of each row: how many splitters are not above it in the order of ``ORDER``."""

    def run(batches):
        for batch in batches:
            keys = [np.concatenate([splitters[:, i], batch.column(c).to_numpy()]) for i, c in enumerate(ORDER)]
            order = np.lexsort(keys[::-1])  # splitters come first and the sort is stable
            passed = np.cumsum(order < len(splitters))
            segment = np.empty(len(order), np.int32)
            segment[order] = passed
            yield batch.append_column("segment", pa.array(segment[len(splitters) :]))

    return run


def top_ranks(rows: DataFrame, draw: int, per_segment: int = ROWS, most: int = SEGMENTS) -> DataFrame:
    """``rows`` (a stored frame with ``ORDER``) with ``rank``: 1 to ``draw`` for the first rows in that order, null for the others.

    With r runs and s segments every run sends about s rows at regular places, so no segment holds much more than twice its share, however the values lie: ``row`` differs in
    all rows, so that equal ones are split as well.
    """
    none = F.lit(None).cast("long")
    total, runs = rows.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.count("*")).first()
    if not total or draw <= 0:
        return rows.withColumn("rank", none)
    number = max(1, min(most, -(-total // per_segment)))
    splitters = np.zeros((0, len(ORDER)), np.int64)
    if number > 1:
        stride = max(1, total // (runs * number))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the run
        sampled = rows.select(*ORDER).sortWithinPartitions(*ORDER).withColumn("place", place).where(F.col("place") % stride == stride // 2).drop("place")
        sampled = stored(sampled, "samples")
        upto = F.floor(F.row_number().over(Window.orderBy(*ORDER)).cast("long") * number / F.lit(max(sampled.count(), 1)))  # shares of the samples up to each
        marked = sampled.withColumn("upto", upto).where(F.col("upto") < number).groupBy("upto").agg(F.min(F.struct(*ORDER)).alias("first")).where("upto > 0").orderBy("upto").select("first.*")
        splitters = np.array([tuple(r[c] for c in ORDER) for r in marked.collect()], np.int64).reshape(-1, len(ORDER))  # at most one for each segment
    dealt = rows.mapInArrow(_segments(splitters), T.StructType([*rows.schema.fields, T.StructField("segment", T.IntegerType())]))
    counts = dict(dealt.groupBy("segment").count().collect())
    starts, before = [], 0
    for segment in sorted(counts):
        if before < draw:
            starts.append((segment, before))
        before += counts[segment]
    last = starts[-1][0]
    start = rows.sparkSession.createDataFrame(starts, "segment int, start long")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*ORDER))
    ranked = dealt.where(F.col("segment") <= last).join(F.broadcast(start), "segment").withColumn("rank", F.col("start") + place)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return ranked.select(*rows.columns, "rank").unionByName(dealt.where(F.col("segment") > last).select(*rows.columns, none.alias("rank")))


def resample(
    documents: DataFrame, target: DataFrame, run_words: int = RUN_WORDS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, key, n_words, n_features, weight, score and rank of every document.

    ``percent`` of the documents with at least ``least_words`` words (rounded down) are drawn, those with the largest scores; of equal ones first those with the smaller doc_id (null
    before all), then with fewer features. ``rank`` counts them from 1 and is null for all others. Words are runs of digits, letters and characters outside ASCII; A to Z are lowered.
    Null and empty texts have no words, weight 0, and are never drawn unless ``least_words`` is 0. Repeated rows are scored and ranked each. Without documents there is no row; an
    empty target only has the one feature added to each bucket. Of both tables only doc_id and text are read.
    """
    found = scores(documents, target, run_words, buckets, seed)
    keyed = found.withColumns({"low": -F.col("score"), "id": F.coalesce("doc_id", F.lit(-(1 << 63)))})
    long = keyed.where(F.col("n_words") >= least_words)
    draw = percent * long.count() // 100
    ranked = top_ranks(long, draw).unionByName(keyed.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return ranked.drop("low", "id", "row")


def drawn_documents(documents: DataFrame, resampled: DataFrame) -> DataFrame:
    """doc_id, text and rank of the documents that ``resampled`` drew; the texts of the others are not shuffled when the drawn ones can be broadcast."""
    drawn = resampled.where("rank IS NOT NULL").select(F.col("doc_id").alias("id"), "key", "rank")
    wanted = drawn.select("id", "key").distinct()
    docs = columns(documents, "doc_id", "text").withColumn("hash", F.xxhash64("text"))
    texts = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.id) & (docs.hash == wanted.key), "left_semi").dropDuplicates(["doc_id", "hash"])
    return texts.join(drawn, texts.doc_id.eqNullSafe(drawn.id) & (texts.hash == drawn.key)).select("doc_id", "text", "rank")
