"""Resampling towards a target, quality from lines, hard negatives."""

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from measures import scores
from plain import LOWER, ROWS, SENTENCE, WORD, documents
from pyspark.sql import functions as F

from tasador.llm import hard_negatives, line_quality, resampling

TARGET = [(1, "wizards brew Bright green wine; wizards sing"), (2, None), (3, ""), (4, "straße 漢字 café " * 5)]


def plain_scores(rows, target, run_words, buckets):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, run_words + 1) for i in range(len(words) - k + 1)], len(words)

    own, far = Counter(), Counter()
    for _, t in rows:
        own.update(features(t)[0])
    for _, t in target:
        far.update(features(t)[0])
    s_all, t_all = sum(own.values()), sum(far.values())
    out = []
    for d, t in rows:
        found, n = features(t)
        weight = sum(math.floor(1000 * math.log((far[b] + 1) * (s_all + buckets) / ((own[b] + 1) * (t_all + buckets)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    return out


def placed(rows, least, percent):
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    draw = percent * len(order) // 100
    ranks = [*range(1, draw + 1), *[None] * (len(order) - draw)]
    return Counter([(*r, k) for r, k in zip(order, ranks)] + [(*r, None) for r in rows if r[1] < least])


@pytest.mark.parametrize("run_words, buckets, least, percent", [(1, 10_000, 20, 10), (3, 97, 0, 100), (2, 10_000, 5, 50)])
def test_resampling_is_that_of_a_plain_loop(spark, run_words, buckets, least, percent):
    rows = ROWS + [(30 + i, "word" * 100 + " " + "x" * i) for i in range(60)]
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = resampling.resample(documents(spark, rows), target, run_words, buckets, least, percent)
    want = placed(plain_scores(rows, TARGET, run_words, buckets), least, percent)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()) == want
    drawn = resampling.drawn_documents(documents(spark, rows), got).collect()
    texts = defaultdict(set)
    for d, t in rows:
        texts[d].add(t)
    assert sorted(r["rank"] for r in drawn) == list(range(1, len(drawn) + 1)) and all(r.text in texts[r.doc_id] for r in drawn)


def test_resampling_of_nothing_and_towards_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(documents(spark, []), none).collect() == []
    got = resampling.resample(documents(spark), none, least_words=1).where("rank IS NOT NULL").count()
    assert got == 10 * sum(bool(WORD.search(t or "")) for _, t in ROWS) // 100


def test_parallel_sort_gives_exact_ranks_and_even_segments(spark):
    """Two thirds of the rows are equal; the segments are small all the same, and ranks are those of a sort."""
    rows = spark.range(0, 6000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.hash("id").cast("long") % 1000).otherwise(F.lit(5)).alias("low"), F.lit(7).cast("long").alias("id"),
        F.lit(0).cast("long").alias("n_features"), F.monotonically_increasing_id().alias("row"),
    )
    seen = []
    kept = resampling._segments
    try:
        resampling._segments = lambda splitters: seen.append(splitters) or kept(splitters)
        got = resampling.top_ranks(rows, 2500, per_segment=200).collect()
    finally:
        resampling._segments = kept
    order = sorted(got, key=lambda r: (r.low, r.id, r.n_features, r.row))
    assert [r["rank"] for r in order] == [*range(1, 2501), *[None] * 3500]
    keys = [tuple(s) for s in seen[0].tolist()]
    assert len(keys) == 29 and keys == sorted(set(keys))
    sizes = Counter(sum(k <= (r.low, r.id, r.n_features, r.row) for k in keys) for r in got)
    assert max(sizes.values()) <= 2 * 200 + 7


def test_checksums_of_ranges_are_those_of_the_library():
    data = np.frombuffer(b"one three " + b"z" * 500 + b" tail", np.uint8)
    starts, ends = np.array([0, 4, 10, 3, 511]), np.array([3, 9, 510, 3, 515])
    got = ~resampling.crc_feed(np.full(5, 0xFFFFFFFF, np.uint32), data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


@pytest.fixture(scope="module")
def chains():
    rng = np.random.default_rng(0)
    lengths = [1, 3, 2, 5, 1, 4]
    bins = rng.integers(0, line_quality.BINS, (sum(lengths), line_quality.FEATURES)).astype(np.uint8)
    return line_quality.Chains(bins, np.repeat(np.arange(6), lengths), 6), lengths, rng.normal(size=line_quality.PARAMETERS) * 0.3


def test_marginals_and_likelihood_are_those_of_all_labellings(chains):
    found, lengths, w = chains
    odds, good = found.odds(w), np.array([True, False, True, False, False, True])
    chain, at, log = w[line_quality.CHAIN + 2 : line_quality.CHAIN + 6].reshape(2, 2), 0, 0.0
    p = found.marginals(w)
    for d, n in enumerate(lengths):
        total, each = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            e = math.exp(w[line_quality.CHAIN + y[0]] + sum(odds[at + i] * y[i] for i in range(n)) + sum(chain[a, b] for a, b in itertools.pairwise(y)))
            total, each = total + e, each + e * np.array(y)
        assert np.allclose(each / total, p[at : at + n])
        at += n
        log += math.log(e / total if good[d] else 1 - e / total)
    value, gradient = found.likelihood(w, good)
    assert math.isclose(value, log)
    for i in range(0, len(w), 7):
        step = np.zeros(len(w))
        step[i] = 1e-5
        assert abs((found.likelihood(w + step, good)[0] - found.likelihood(w - step, good)[0]) / 2e-5 - gradient[i]) < 1e-6


def test_a_long_chain_keeps_its_numbers(chains):
    rng = np.random.default_rng(1)
    bins = rng.integers(0, line_quality.BINS, (50_000, line_quality.FEATURES)).astype(np.uint8)
    p = line_quality.Chains(bins, np.zeros(50_000, np.int64), 1).marginals(chains[2])
    assert np.isfinite(p).all() and (p >= 0).all() and (p <= 1).all()


def test_lines_of_texts():
    texts = ["a\n\nb", "", None, "\n\n", " x ", "é" * 100 + "\n" + "!!! " * 3]
    bins, rows, starts, ends = line_quality.line_features(pa.array(texts))
    assert (rows.tolist(), starts.tolist(), ends.tolist()) == ([0, 0, 4, 5, 5], [0, 3, 0, 0, 201], [1, 4, 3, 200, 213])
    assert bins.shape == (5, line_quality.FEATURES) and bins.max() < line_quality.BINS


@pytest.mark.parametrize("sf, least", [("sf0.001", 0.85), ("sf0.01", 0.95)])  # learned from 70 and from 330 labels
def test_quality_on_labels_that_were_held_out(spark, sf, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = line_quality.quality(docs, labels)
    assert found.count() == docs.count() and found.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.3 AS INT)").count() == 0
    rows = found.where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    precision, recall, auc = scores(rows, line_quality.THRESHOLD)
    assert precision > least and recall > 0.97 and auc > least


def test_lines_of_a_mixed_document_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_quality.learn(docs, labels)
    good = docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").limit(20).collect()
    mixed = [(i, f"{r.text}\n{'HEATAT!! THERHAOU!! OUSHED!! ' * 30}\n{r.text}") for i, r in enumerate(good)]
    lines = line_quality.labelled_lines(documents(spark, mixed), model).collect()
    shouted = [r for r in lines if mixed[r.doc_id][1].encode()[r.start : r.end].startswith(b"HEATAT!!")]
    others = [r for r in lines if r not in shouted]
    assert len(shouted) == 20 and sum(r.good for r in shouted) <= 2 and sum(r.good for r in others) >= 0.9 * len(others)


def test_quality_of_awkward_tables(spark):
    docs = documents(spark, ROWS + [(40, "\n\n")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in line_quality.quality(docs, none).collect()} == {0.5}
    assert line_quality.quality(documents(spark, []), none).collect() == []
    one_kind = spark.createDataFrame([(1, 1, "x"), (1, 1, "x"), (None, 1, "x"), (3, None, "x"), (999, 0, "x")], "doc_id long, quality int, text string")
    assert len({r.score for r in line_quality.quality(docs, one_kind).collect()}) == 1
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (14, 0), (15, 0), (16, 1), (6, 0), (5, 1)], "doc_id long, quality int")
    rows = line_quality.quality(docs, labels, rounds=5).collect()
    assert len(rows) == len(ROWS) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (5, 6, 40)}) == 1 and len({r.score for r in rows if r.doc_id == 16}) == 1
    assert {r.held_out for r in rows if r.doc_id is None} == {False}


def whole(x):
    return math.floor(Fraction(float(x)) * 256)


@pytest.mark.parametrize("size, scale", [(64, 1.0), (64, 1e6), (300, 3.0), (3000, 1.0), (8, 1e300), (1, 1e-9), (16, 1e12)])
def test_block_scores_are_exact(size, scale):
    rng = np.random.default_rng(size)
    a, b = rng.normal(size=(3, size)) * scale, rng.normal(size=(20, size)) * scale
    most = hard_negatives.MOST
    want = [[max(-most, min(most, sum(whole(p) * whole(q) for p, q in zip(x, y)))) for y in b] for x in a]
    assert np.concatenate([s for _, s in hard_negatives.block_scores(a, b)]).tolist() == want


def plain_negatives(rows, every, positives, negatives, low, high):
    """Lists of every anchor row, by its place in ``rows``."""
    vectors = [[whole(x) for x in v] for _, _, v in rows]
    out = Counter()
    for a, (anchor, label, _) in enumerate(rows):
        if anchor % every:
            continue
        score = [max(-(1 << 60), min(1 << 60, sum(p * q for p, q in zip(vectors[a], v)))) for v in vectors]
        order = sorted((i for i, r in enumerate(rows) if r[0] != anchor), key=lambda i: (-score[i], rows[i][0], i))
        for p in [i for i in order if rows[i][1] == label][:positives]:
            inside = [i for i in order if rows[i][1] != label and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out.update((anchor, rows[p][0], k + 1, rows[i][0], score[p], score[i]) for k, i in enumerate(inside))
    return out


def test_hard_negatives_are_those_of_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 3), (np.float32(rng.normal(size=8) + 1)).tolist()) for i in range(300)]
    rows += [(400 + i, 1, rows[20][2]) for i in range(40)] + [(500 + i, 2, rows[20][2]) for i in range(40)]  # ties, more than are wanted
    rows += [(20, 2, rows[20][2]), (40, 1, rows[7][2]), (600, 0, [1e300] * 8), (601, 0, [-1e300] + [1e299] * 7), (602, 1, [9e299] * 8), (603, 1, [1.7e308] * 8), (620, 2, [0.0] * 8)]
    odd = [(None, 1, rows[0][2]), (640, None, rows[0][2]), (660, 1, None), (680, 1, []), (700, 1, [float("nan")] * 8), (720, 1, [float("inf")] + [0.0] * 7), (740, 1, [None] * 8), (760, 1, [1.0] * 3)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, label int, embedding array<double>, block int, tile string").repartition(5)
    for low, high in ((80, 100), (-50, 130)):
        got = hard_negatives.hard_negatives(frame, every=20, low=low, high=high).collect()
        have = Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)
        assert have == plain_negatives(rows, 20, 5, 5, low, high) and have
    lists = defaultdict(set)
    for r in got:
        lists[r.anchor_id].add(r.anchor)
    assert len(lists[20]) == 2


def test_hard_negatives_in_many_blocks_and_of_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(3)), (np.float32(rng.normal(size=4) + 1)).tolist()) for i in range(200)]
    kind = "vec_id long, label int, embedding array<float>"
    for name, value in (("ROWS", 30), ("LEAST_ROWS", 30), ("ANCHORS", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, kind), every=10).collect()
    assert Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got) == plain_negatives(rows, 10, 5, 5, 80, 100)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], kind)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(7, 1, [1.0])], kind)).collect() == []
    assert hard_negatives.hard_negatives(spark.createDataFrame([(100, 1, [1.0])], kind)).collect() == []
