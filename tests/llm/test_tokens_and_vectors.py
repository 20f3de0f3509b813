import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from plain import ROWS, documents
from tokenizers import Tokenizer

from tasador.llm import bit_search, byte_bpe, packing, permutation_search, sharding, toxicity
from tasador.llm.vectors import usable_vectors

RANKS, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    parts = ["a", "b", "the ", "  ", "\n", " ", "　", "é", "ü", "1", "２", "!", "'s", "'ll", "\x1c", "​", " ", "\r\n", "\t", "中文", "😀", "x'd", "\x85", "́", "<|endoftext|>", "\x00"]
    return [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(1500)]


def test_byte_bpe_is_that_of_the_library(spark, odd_texts):
    rows = ROWS + odd_texts
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.Vocabulary(RANKS, public_tokenizers.PATTERN).ranks, special_tokens={})
    got = byte_bpe.encode_decode(documents(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = sorted(((d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows), key=key)
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=key) == want


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    assert sorted(byte_bpe.PerfectHash(keys)(keys).tolist()) == list(range(len(keys)))


def test_pieces_and_sequences(spark, odd_texts):
    rows = [r for r in ROWS if r[0] not in (None, 16)] + odd_texts
    tokenizer = Tokenizer.from_file(WORDS)
    want = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    docs = documents(spark, rows)
    placed = packing.pack_documents(docs, WORDS)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in placed.collect():
        own = want[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        assert r.length <= 2048 and (r.start, r.piece) == (2048 * r.piece, r.piece)
        by_doc[r.doc_id].append(r.length)
        sequences[r.sequence_id].append((r.offset, r.length, own))
    assert {d: sum(x) for d, x in by_doc.items()} == {d: len(x) for d, x in want.items()}
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts, key=lambda p: p[:2]):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, want.values()))
    assert len(sequences) <= math.ceil(total / 2048) + 2
    real = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, WORDS).collect()}
    assert real == {s: [i for _, _, own in sorted(parts, key=lambda p: p[:2]) for i in own] for s, parts in sequences.items()}


def test_sum_of_squares_wastes_little():
    sizes = np.random.default_rng(0).integers(1, 2049, 5000)
    sequence, offset = packing.sum_of_squares(sizes)
    assert sequence.max() + 1 <= 1.02 * sizes.sum() / 2048
    ends = offset + sizes
    assert ends.max() <= 2048


def test_packing_of_repeated_rows_null_ids_and_nothing(spark):
    assert packing.pack_documents(documents(spark), WORDS).select("doc_id").where("doc_id IS NULL").count() == 2
    assert packing.pack_documents(documents(spark, []), WORDS).collect() == []
    assert byte_bpe.encode_decode(documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def jump(key: int, shards: int) -> int:
    at = ahead = 0
    while ahead < shards:
        at, key = ahead, (key * int(sharding.STEP) + 1) % 2**64
        ahead = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


def test_jump_hash_moves_only_into_the_new_shard():
    keys = np.random.default_rng(2).integers(0, 2**63, 3000, dtype=np.uint64)
    eight, nine = sharding.jump_hash(keys, 8), sharding.jump_hash(keys, 9)
    assert eight.tolist() == [jump(int(k), 8) for k in keys]
    assert set(nine[eight != nine]) == {8} and abs((nine == 8).mean() - 1 / 9) < 0.03


def test_shards_and_slots(spark):
    got = sharding.shard_documents(documents(spark)).collect()
    assert len(got) == len(ROWS) and {r.law for r in got} == {"key"}
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(x) == 1 for x in by_id.values())
    texts = {d: (t or "").encode() for d, t in ROWS}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in got if r.doc_id is not None)
    assert sharding.shard_documents(documents(spark, [])).collect() == []


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=16) / 4)]) for i in range(900)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)] + [(40, rows[40][1]), (None, rows[3][1]), (2000, None), (2001, []), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16)]
    rows += [(2004, [None] * 16), (2005, [1.0] * 3), (2020, [0.0] * 16)]
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, block int"), [r for r in rows if r[0] is not None and r[1] and len(r[1]) == 16 and all(x is not None and math.isfinite(x) for x in r[1])]


def test_top_k_is_exact(spark, vectors):
    frame, rows = vectors
    got, want = Counter(), Counter()
    got.update((r.query_id, r.rank, r.vec_id, r.score) for r in bit_search.top_k(frame).collect())
    whole = [(i, np.floor(64 * np.array(x, float)).astype(int)) for i, x in rows]
    for q, x in whole:
        if q % 20 == 0:
            best = sorted(((-int(x @ y), i) for i, y in whole if i != q))[:20]
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
    assert got == want


def test_two_rows_of_an_id_are_two_queries(spark):
    rows = [(i, [float(i % 7), float(i % 5) - 2]) for i in range(1, 90)] + [(20, [-1.0, 3.0]), (20, [-1.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for run in (bit_search.top_k, permutation_search.nearest):
        want = Counter()
        for q, x in rows:
            if q % 20 == 0:
                scale = 64 if run is bit_search.top_k else 1
                best = sorted((-sum(a * b for a, b in zip(x, y)) * scale**2, i) for i, y in rows if i != q)[:20]
                want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in run(frame).collect()) == want


def test_large_components(spark):
    rows = [(i, [float(i), 1.0, -2.0]) for i in range(1, 60)] + [(60, [1e300, 1.0, 0.0]), (61, [-1e300, 0.5, 0.0]), (80, [1e12, -1e12, 3e15])]
    limit = lambda x: max(-(1 << 61), min(1 << 61, math.floor(64 * x)))
    whole = [(i, [limit(x) for x in v]) for i, v in rows]
    want = []
    for q, x in whole:
        if q % 20 == 0:
            score = [(-max(1 - (1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(x, y)))), i) for i, y in whole if i != q]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(score)[:20])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in bit_search.top_k(frame).orderBy("query_id", "rank").collect()]
    assert [r for r in got if r[0] != 60 and r[0] != 80] == [r for r in want if r[0] not in (60, 80)]
    assert sorted(r[3] for r in got) == sorted(r[3] for r in want) and len(got) == len(want)
    assert permutation_search.nearest(frame).count() == len(want)


def test_nearest_finds_nearly_all(spark, vectors):
    frame, rows = vectors
    got = defaultdict(list)
    for r in permutation_search.nearest(frame).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    rows = [(i, np.array(x, float)) for i, x in rows if any(x)]
    found = total = 0
    for q, x in rows:
        if q % 20 == 0:
            score = {i: sum(a * b for a, b in zip(x, y)) for i, y in rows if i != q}
            best = sorted(score, key=lambda i: (-score[i], i))[:20]
            lists = sum(i == q for i, _ in rows)  # a repeated query row has its list as often
            mine = sorted(got[q], key=lambda p: (-p[1], p[0]))[::lists]
            assert len(mine) == 20 and all(math.isclose(s, score[i]) for i, s in mine)
            found, total = found + len(set(best) & {i for i, _ in mine}), total + 20
    assert found >= 0.9 * total


def test_recall_on_the_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.select("vec_id", "embedding").toPandas().sort_values("vec_id")
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding.to_numpy()).astype(float)
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    got = defaultdict(set)
    for r in permutation_search.nearest(frame).collect():
        got[r.query_id].add(r.vec_id)
    asked = np.flatnonzero(ids % 20 == 0)
    recall = np.mean([len(got[ids[q]] & set(ids[np.argsort(-score[q], kind="stable")[:20]].tolist())) / 20 for q in asked])
    assert recall >= 0.9


def test_vectors_of_empty_tables(spark, vectors):
    none = vectors[0].where("false")
    assert bit_search.top_k(none).collect() == [] and permutation_search.nearest(none).collect() == [] and usable_vectors(none).count() == 0


def test_equal_vectors_come_by_vec_id(spark):
    """Also when more rows are equal than are reranked."""
    frame = spark.createDataFrame([(i, [1.0, 0.5] if i % 3 else [0.0, -1.0]) for i in range(2400)], "vec_id long, embedding array<double>")
    for run in (bit_search.top_k, permutation_search.nearest):
        got = [r.vec_id for r in run(frame).where("query_id = 20").orderBy("rank").collect()]
        assert got == [i for i in range(60) if i % 3 and i != 20][:20]


def test_few_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in bit_search.top_k(frame).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert [(r.rank, r.vec_id) for r in permutation_search.nearest(frame).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_search_in_the_index_is_exact():
    rng = np.random.default_rng(5)
    idf = rng.uniform(1, 5, 40)
    rows = []
    for i in range(400):
        term = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        rows.append((i, term.tolist(), rng.integers(1, 4, len(term)).tolist(), int(rng.integers(0, 2))))
    index = toxicity.Examples(rows, idf)
    dense = np.zeros((400, 40 + len(toxicity.RICHNESS)))
    for i, r in enumerate(index.rows):
        dense[i, r[1]] = r[2]
    for i in range(0, 400, 7):
        cosine = np.minimum(np.round(dense @ dense[i], 12), 1.0)
        at, value = index.nearest(index.rows[i][1], index.rows[i][2], 15)
        assert np.allclose(value, np.sort(cosine)[::-1][:15], atol=1e-9) and np.allclose(cosine[at], value, atol=1e-9)


def test_toxicity_on_held_out_labels(spark):
    from measures import scores

    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    precision, recall, order = scores([(r.score, r.toxic) for r in got], 0.7)
    assert precision >= 0.9 and recall >= 0.75 and order >= 0.85


@pytest.mark.parametrize("sf,least_recall,least_order", [("sf0.001", 0.4, 0.7), ("sf0.01", 0.75, 0.9)])
def test_toxicity_of_few_labels(spark, sf, least_recall, least_order):
    """Terms are chosen from a few dozen labels as well."""
    from measures import scores

    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet") for name in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    precision, recall, order = scores([(r.score, r.toxic) for r in got], 0.7)
    assert precision >= 0.9 and recall >= least_recall and order >= least_order


def test_terms_go_with_the_label_by_more_than_chance():
    """Three toxic documents of three are much among 52 labels, and as chance has it among many rare terms."""
    assert toxicity.least_toxic({3: 300, 2: 1500}, {(3, 0): 9, (2, 0): 10, (2, 1): 4}, 6, 46) == [(3, 3)]
    assert toxicity.least_toxic({3: 9000, 2: 1500}, {(3, 0): 9, (2, 0): 10}, 6, 46) == []
    assert toxicity.least_toxic({1: 5}, {}, 0, 52) == toxicity.least_toxic({}, {}, 0, 0) == []


def test_toxicity_of_awkward_rows_and_without_labels(spark):
    labels = spark.createDataFrame([(10, 1), (11, None), (None, 1), (1, 0), (1, 0)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        got = toxicity.toxicity(documents(spark), known).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(documents(spark, []), labels).collect() == []


def test_choices_of_the_sum_of_squares_rule():
    """Every piece goes where the sum, computed from the start, is smallest among the open sequences with room; a new one is the last resort."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        capacity = int(rng.integers(2, 25))
        sizes = rng.integers(1, capacity + 1, int(rng.integers(0, 60)))
        gaps, want = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            options = []
            for k, gap in enumerate(gaps):
                if gap >= sizes[i]:
                    after = [g for g in [*gaps[:k], gap - sizes[i], *gaps[k + 1 :]] if g]
                    options.append((sum(after.count(g) ** 2 for g in set(after)), gap))
            gap = min(options)[1] if options else capacity
            want[i] = capacity - gap
            if options:
                gaps.remove(gap)
            gaps.append(gap - sizes[i])
        sequence, offset = packing.sum_of_squares(sizes, capacity)
        assert offset.tolist() == [want[i] for i in range(len(sizes))] and len(set(sequence.tolist())) == len(gaps)
