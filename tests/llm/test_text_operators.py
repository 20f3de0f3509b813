import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from plain import ROWS, SENTENCE, documents, kept_bytes, license_places, near_duplicates, personal_data, sha

from tasador.llm import licenses, ngram_join, pii, suffix_array, suffix_dedup
from tasador.llm.components import components, stars
from tasador.llm.scratch import bit_table

UNIQUE = [(d, t) for i, (d, t) in enumerate(ROWS) if d is not None and (d, t) not in ROWS[:i]]


def edited(seed, families=12, copies=6, words=90):
    """Families of near copies with a passage that all documents share."""
    rng, rows = random.Random(seed), []
    for f in range(families):
        base = [f"f{f}w{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(words)] = f"new{rng.randrange(10**6)}"
            at = rng.randrange(words)
            rows.append((len(rows), " ".join(own[:at]) + " " + SENTENCE + " " + " ".join(own[at:])))
    return rows


def test_near_duplicates_of_awkward_rows(spark):
    got = ngram_join.near_duplicates(documents(spark)).collect()
    assert len(got) == len(ROWS)
    want = near_duplicates(UNIQUE)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert want[4][1] == 1 and want[5] == (0, 5)


@pytest.mark.parametrize("small", [24, 2])
def test_near_duplicates_of_families(spark, monkeypatch, small):
    """Also when almost every cell counts as large and goes through crowds and blocks."""
    monkeypatch.setattr(ngram_join, "_meet", limited(small))
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = edited(small)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == near_duplicates(rows)


def test_cells_that_touch_are_not_one_crowd(spark, monkeypatch):
    """Each document shares a sentence with the next one: classes meet where they share a cell, and the chain of all of them is never compared as a whole."""
    kept, before = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "_meet", limited(1))
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: kept.setdefault(name, before(df, name)))
    sentence = lambda i: " ".join(f"s{i}w{k}" for k in range(12))
    rows = [(i, f"{sentence(i)} {sentence(i + 1)}") for i in range(60)] + [(100 + i, f"{sentence(i)} {sentence(i + 1)} more") for i in range(0, 60, 7)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == near_duplicates(rows)
    crowds = {}
    for r in kept["crowds"].collect():
        crowds.setdefault(r.crowd, set()).add(bytes(r.node))
    assert len(set().union(*crowds.values())) > 50 and max(map(len, crowds.values())) <= 10


def test_jobs_do_not_grow_with_shuffle_partitions(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "_meet", limited(2))
    rows, before = edited(0), {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    jobs = []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (4, 32):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.sparkContext.setJobGroup(f"near duplicates {n}", "")
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
            assert got == near_duplicates(rows)
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"near duplicates {n}")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert jobs[1] <= jobs[0] + 16


def test_components_of_paths_stars_and_random_edges(spark):
    rng = random.Random(1)
    path = [i for i in range(100, 160)]
    rng.shuffle(path)
    edges = [*zip(path, path[1:]), *((500, i) for i in range(501, 540)), (7, 7), (9, 8), (8, 9), *((rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(40))]
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in least:
        for u, v in edges:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    frame = spark.createDataFrame(edges, "u long, v long")
    assert {r.node: r.component for r in components(frame).collect()} == least
    assert components(frame.where("u = v")).count() == 0


def test_stars_are_told_from_other_graphs(spark):
    for edges, want in (([], True), ([(2, 1), (3, 1), (9, 8)], True), ([(2, 1), (3, 2)], False), ([(3, 1), (3, 2)], False)):
        assert stars(spark.createDataFrame(edges, "u long, v long"), 2) is want


def test_bits_of_a_table(spark):
    size, places = 1 << 17, {0, 7, 8, 32767, 32768, (1 << 17) - 1}
    table = bit_table(spark.createDataFrame([(p,) for p in [*places] * 2], "place long"), size)
    assert set(np.flatnonzero(np.unpackbits(table, bitorder="little")).tolist()) == places
    assert not bit_table(spark.createDataFrame([], "place long"), size).any()


def limited(small):
    def run(packs):
        import tasador.llm.ngram_join as module

        module.SMALL, before = small, module.SMALL
        try:
            return module._meet(packs)
        finally:
            module.SMALL = before

    return run


def test_one_id_with_two_texts(spark):
    rows = [(1, SENTENCE), (1, "other words that stand for themselves alone"), (2, SENTENCE.replace("ships", "boats"))]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(1, 20, 1), (1, 3, 1), (2, 20, 1)}


def test_linked_sets_share_a_cell():
    rng = np.random.default_rng(0)
    for n in [1, 2, 3, 4, 5, 7, 8, 20, 100, 127, 128, 129, 300, 1000, 5000]:
        for _ in range(8):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            most = int(ngram_join.most_apart(len(a), len(a)))
            drop = rng.integers(0, most // 2 + 1)
            b = np.unique(np.concatenate([a[rng.permutation(len(a))[drop:]], rng.integers(0, 2**63, drop, dtype=np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if len(b) and 100 * inter >= 75 * (len(a) + len(b) - inter):
                hot = np.zeros(ngram_join.FLAGS // 8, np.uint8)
                for token in rng.permutation(a)[: n // 2].tolist():
                    hot[token % ngram_join.FLAGS >> 3] |= 1 << (token % 8)
                assert len(np.intersect1d(ngram_join.cells(a, hot), ngram_join.cells(b, hot)))
                x, y = (np.frombuffer(ngram_join.bit_sketch(s), np.uint8) for s in (a, b))
                bits = min(len(x), len(y))
                assert np.bitwise_count(ngram_join.fold(x, bits) ^ ngram_join.fold(y, bits)).sum() <= len(a) + len(b) - 2 * inter


def test_suffix_array_is_the_sorted_order():
    rng = np.random.default_rng(1)
    for trial in range(150):
        lengths = rng.integers(1, 25, rng.integers(1, 8))
        flat = rng.integers(*((0, 256) if trial % 3 == 0 else (97, 98 + trial % 4)), lengths.sum()).astype(np.uint8)
        s = suffix_array.Segments(flat, lengths)
        which = np.searchsorted(s.last, np.arange(len(s.byte)))

        def key(p):
            return [*(int(x) + 1000 for x in s.byte[p : s.last[which[p]]]), which[p]]

        assert suffix_array.suffix_array(s).tolist() == sorted(range(len(s.byte)), key=key)


@pytest.mark.parametrize("many", [suffix_dedup.MANY, 1])
def test_repeats_of_awkward_rows_and_families(spark, many):
    """Also when every anchor is sent window by window."""
    for rows in (ROWS[:10] + ROWS[12:], edited(7)):
        got = sorted((r.doc_id or -1, r.n_bytes, sha(bytes(r.kept)), len(r.starts)) for r in suffix_dedup.remove_repeats(documents(spark, rows), many).collect())
        assert got == sorted((d or -1, len(b), sha(k), n) for d, b, k, n in kept_bytes(rows))


def test_many_groups_take_no_steps_of_their_own():
    """Packs for as many shards as segments cost about what packs for a few cost, and hold the same."""
    rng, n, size = np.random.default_rng(0), 30_000, 1_000_000
    text = rng.integers(97, 123, size).astype(np.uint8).tobytes().decode()
    asks = np.zeros(n, suffix_dedup._ASK)
    asks["gram"], asks["at"], asks["more"] = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, size - 100, n), rng.integers(0, 30, n)
    batch = pa.RecordBatch.from_pydict({"doc_id": [7], "key": [8], "text": [text], "asks": pa.array([[asks.tobytes()]], pa.list_(pa.binary()))})
    took, sent = [], []
    for shards in (16, 16, 1 << 20):
        began = time.process_time()
        packs = list(suffix_dedup._send(shards)([batch]))
        took.append(time.process_time() - began)
        rows = pa.Table.from_batches(packs).to_pylist()
        at = [int(a) for r in rows for a in np.frombuffer(r["starts"], "<u4")]
        flat, lengths = b"".join(r["flat"] for r in rows), [int(x) for r in rows for x in np.frombuffer(r["lengths"], "<u4")]
        cuts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        assert all(flat[x:y] == text[a : a + y - x].encode() for a, x, y in zip(at, cuts, cuts[1:]))
        assert all(r["ids"] == np.int64(7).tobytes() and r["keys"] == np.int64(8).tobytes() and not any(np.frombuffer(r["owners"], "<u4")) for r in rows)
        assert len({r["shard"] for r in rows}) == len(rows)
        sent.append(sorted(zip(at, lengths)))
    assert sent[0] == sent[2] == sorted(zip(asks["at"].tolist(), (asks["more"].astype(int) + suffix_dedup.LENGTH).tolist()))
    assert took[2] < 8 * took[1] + 0.3


def test_repeats_of_very_long_texts(spark):
    rows = ROWS[10:12]
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got[11] == rows[0][1].encode() and got[12] == b""


def test_shortened_texts_lose_halves_of_characters(spark):
    got = {r.doc_id: r.kept_text for r in suffix_dedup.shortened_texts(documents(spark, [(1, "é" * 60), (2, "zz" + "é" * 60), (3, None)])).collect()}
    assert got == {2: "zz"}


def test_personal_data_of_awkward_rows(spark):
    got = pii.personal_data_summary(documents(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        texts = [t for d, t in ROWS if d == r.doc_id]
        wants = [",".join(f"{k}:{a}:{b}" for k, a, b in personal_data(t)) for t in texts]
        assert r.base_sha256 in [sha(w.encode()) for w in wants] and any(r.spans.startswith(w) for w in wants)


def test_patterns_match_plain_regular_expressions():
    rng, parts = random.Random(3), ["a", "b@", "@", ".", "c.d", "-", "1", "2", "255", "4111 1111 1111 1111", "+1 (", "555", ")", " ", "1.2.3.4", "x@y.z", "é", "\n", "٣", "+", "00", "007.1.1.1"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.entities(text) == personal_data(text)


def test_disclosing_terms(spark):
    """A word that stands only by one address reveals it; words that stand everywhere do not."""
    rows = [(i, f"the note {i} of zanzibar goes to ann@example.org and the others") for i in range(4)] + [(10 + i, f"the note {i} goes to me and the others") for i in range(200)]
    got = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    words = {i: {rows[i][1][s.start : s.end] for s in got[i].terms} for i in range(4)}
    assert all("zanzibar" in w and not w & {"the", "and", "others", "goes", "to"} for w in words.values())
    assert all(not got[10 + i].terms and not got[10 + i].spans for i in range(200))
    clean = {r.doc_id: r.clean_text for r in pii.sanitised_texts(documents(spark, rows)).collect()}
    assert set(clean) == set(range(4)) and "[EMAIL]" in clean[0] and "zanzibar" not in clean[0] and "ann" not in clean[0]


def disclosed_words(spark, rows, **how):
    return {r.doc_id: {rows[r.doc_id][1][s.start : s.end] for s in r.terms} for r in pii.personal_data(documents(spark, rows), **how).collect()}


@pytest.mark.parametrize("copies", [1, 2])
def test_terms_that_disclose_rare_entities(spark, copies):
    """An entity in one or two documents has disclosing terms as well; what other documents have too reveals little."""
    texts = [f"the note of Zanzibar goes to ann@example.org and the others {'again ' * i}" for i in range(copies)] + ["the note of me goes to the others and again"] * 200
    got = disclosed_words(spark, [*enumerate(texts)])
    assert all(got[i] == ({"Zanzibar"} if i < copies else set()) for i in got)


def test_disclosing_terms_anywhere(spark):
    """Far from the entity, again in the same text, and in a document without it."""
    far = "and so it goes on with many words about nothing " * 10
    texts = [f"é Mary {far} ann@example.org {far} mary, mary@example.org and MARY", f"ann@example.org {far} Mary", f"Ann {far} ann@example.org", f"{far} of Mary"] + [far] * 2000
    rows = [*enumerate(texts)]
    got = {r.doc_id: [rows[r.doc_id][1][s.start : s.end] for s in r.terms] for r in pii.personal_data(documents(spark, rows), everywhere=True).collect()}
    assert got[0] == ["é", "Mary", "mary", "MARY"] and got[1] == ["Mary"] and got[2] == ["Ann"] and "Mary" in got[3]
    assert all(not got[i] for i in range(4, len(rows)))
    there = {r.doc_id: [rows[r.doc_id][1][s.start : s.end] for s in r.terms] for r in pii.personal_data(documents(spark, rows)).collect()}
    assert there == got | {3: []}


def test_disclosing_terms_by_plain_counts(spark):
    """Also terms and entities in a large part of all documents."""
    rng = random.Random(5)
    names = [f"p{i}@example.org" for i in range(12)] + ["10.0.0.1"] * 20
    texts = []
    for i in range(400):
        some = rng.sample(names, rng.choice([0, 0, 1, 2]))
        words = [f"Near{n[:2]}" for n in some if rng.random() < 0.9] + [f"w{int(rng.paretovariate(0.4)) % 997}" for _ in range(30)]
        texts.append(" ".join(rng.sample(words + some, len(words) + len(some))))
    of = [{w.lower() for w in t.split() if "." not in w} for t in texts]
    holds = [{w for w in t.split() if "." in w} for t in texts]
    count = lambda sets, x: sum(x in s for s in sets)
    risky = set()
    for e in set(names):
        n, shared = count(holds, e), {w for h, s in zip(holds, of) if e in h for w in s}
        for w in shared:
            both = sum(e in h and w in s for h, s in zip(holds, of))
            if np.log(both * 400 / (n * (count(of, w) + 0.5))) >= 0.9 * np.log(400 / n):
                risky.add(w)
    for everywhere in (True, False):
        got = disclosed_words(spark, [*enumerate(texts)], everywhere=everywhere)
        assert risky and {i: {w.lower() for w in s} for i, s in got.items()} == {i: s & risky if everywhere or holds[i] else set() for i, s in enumerate(of)}


def test_documents_without_an_entity_stay_as_they_are(spark):
    """Over a whole table: hardly any text without an entity is altered, and every entity is gone from the others."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()}
    free = {(d, t) for d, t in texts if not personal_data(t or "")}
    clean = {r.doc_id: r.clean_text for r in pii.sanitised_texts(table).collect()}
    assert len(free) > 100 and sum(d in clean for d, _ in free) < 0.05 * len(free)
    assert all(d in clean and clean[d] != t for d, t in texts - free)


def test_license_scan_of_awkward_rows(spark):
    got = licenses.license_summary(documents(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        wants = [license_places(t) for d, t in ROWS if d == r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in [(n, len(s), s[0] if s else None, s[-1] if s else None, ",".join(b)) for n, s, b in wants]
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_license_templates_with_gaps(spark):
    text = "x " * 20 + "Permission is hereby granted, free of charge, to any person obtaining one copy of this software and its associated documentation files (the"
    rows = [(1, text), (2, "permission is hereby refused to any person"), (3, "Licensed under CC BY-NC 4.0.")]
    got = {r.doc_id: r for r in licenses.license_summary(documents(spark, rows)).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and got[2].labels == "" and got[3].labels == "cc-by-nc"


def plain_spans(words, template):
    """(first word, last word, share) of the runs of neighbouring diagonals on which enough pairs of the template stand."""
    votes = [(p - t, p, t) for p in range(len(words) - 1) for t in range(len(template) - 1) if words[p : p + 2] == template[t : t + 2]]
    chains = []
    for v in sorted(votes):
        if chains and v[0] - chains[-1][-1][0] <= licenses.NEAR:
            chains[-1].append(v)
        else:
            chains.append([v])
    for chain in chains:
        first, last, share = min(v[1] for v in chain), max(v[1] for v in chain) + 1, len({v[2] for v in chain}) / (len(template) - 1)
        if share >= licenses.ENOUGH:
            assert last - first <= licenses.STRETCH * len(template)  # one span of bounded length
            yield first, last, share


def test_license_templates_beside_a_plain_version(spark):
    """Whole texts and beginnings with words left out, added and changed, between words of other kinds; pairs of frequent words vote as well."""
    rng = random.Random(11)
    known = [(re.findall("[a-z0-9]+", text.lower()), label) for text, label in licenses.TEMPLATES + licenses.WHOLE]
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(50)}" for _ in range(30)]
        for w in known[i % len(known)][0]:
            words += rng.choices([[w], [], [w, "added"], ["other"]], [94, 2, 2, 2])[0]
        rows.append((i, " ".join(words + [f"w{rng.randrange(50)}" for _ in range(30)])))
    by_row, found = licenses.scan(documents(spark, rows), phrases=())
    of = {r.row: r.doc_id for r in by_row.collect()}
    got = sorted((of[r.row], r.label, r.first_word, r.last_word, round(r.score, 9)) for r in found.collect())
    want = sorted((i, label, a, b, round(s, 9)) for i, text in rows for template, label in known for a, b, s in plain_spans(text.split(), template))
    assert got == want and sum(b - a > 100 for _, _, a, b, _ in got) >= 6


def test_too_many_templates_are_refused(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MOST", 100)
    with pytest.raises(ValueError, match="parts"):
        licenses.scan(documents(spark))


def test_license_stretches_of_long_chains(spark):
    """Words of a template that go on after it do not hide it, and a template may have more words than a number has bits."""
    rows = [(1, "licensed under cc by sa 4 0 4 0 4 0 4 0 4 0"), (2, "released under the mit license mit license mit license mit license"), (3, "4 0 " * 30)]
    rows.append((4, " ".join(["licensed under cc by sa 4 0" + " 4 0" * 9] * 2)))
    of = {r.row: r.doc_id for r in licenses.scan(documents(spark, rows))[0].collect()}
    found = sorted((of[r.row], r.label, r.first_word, r.last_word, r.score) for r in licenses.scan(documents(spark, rows), phrases=())[1].collect())
    assert found == [(1, "cc-by-sa", 0, 6, 1.0), (2, "mit", 0, 4, 1.0), (4, "cc-by-sa", 0, 6, 1.0), (4, "cc-by-sa", 25, 31, 1.0)]
    text = " ".join(f"word{i}" for i in range(300))
    found = licenses.scan(documents(spark, [(1, "x " + text + " y")]), phrases=((text, "phrase"),), templates=((text, "whole"),))[1].collect()
    assert sorted((r.label, r.exact, r.first_word, r.last_word, r.score) for r in found) == [("phrase", True, 1, 300, 1.0), ("whole", False, 1, 300, 1.0)]


@pytest.mark.parametrize("run", [ngram_join.near_duplicates, suffix_dedup.repeat_summary, pii.personal_data_summary, licenses.license_summary])
def test_empty_tables(spark, run):
    assert run(documents(spark, [])).collect() == []


def test_hashes_do_not_depend_on_neighbours():
    from tasador.llm.text import hash_spans, utf8

    texts = ["a", "abcdefgh", "abcdefghi", "", "x" * 100]
    data, bounds = utf8(pa.array(texts))
    joined = hash_spans(data, bounds[:-1], bounds[1:])
    for t, h in zip(texts, joined):
        data, bounds = utf8(pa.array([t]))
        assert hash_spans(data, bounds[:-1], bounds[1:])[0] == h


def test_personal_data_reads_a_bounded_part_of_a_batch_at_once():
    """Places take many times the bytes of a text, so that the memory of a worker is set by what is read at once."""
    import pyarrow as pa

    from tasador.llm import pii

    text_ = "word " * 4000
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "key": list(range(100)), "text": [text_] * 100})
    assert sum(b.num_rows for b in pii._term_counts([batch])) >= 4  # 2 MB of texts in parts of 512 KB
