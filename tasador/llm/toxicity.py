"""Toxicity scores from the nearest labelled examples.

Terms are words and the first four and six bytes of words. From a bounded sample of labelled documents, the terms that go with the label are chosen so
that few of them can be expected to go with it by chance, whatever the number of labels; each document is its TF-IDF vector over them, with document frequencies counted over all documents. The examples are kept as a block-max inverted index: per
term the postings by block of examples and the largest weight in each block. A query adds these maxima up to a bound on the cosine in each block and scores blocks in order of
the bound until no other block can hold one of the k nearest, which makes the search exact. The neighbours vote with the square of their similarity; isotonic
regression over the examples (each without itself) turns votes into probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored
from tasador.llm.text import LOWER, NOT_WORD, hash_spans, pieces, spans, utf8

#: Labelled rows that are learned from: those with the smallest hash of doc_id.
EXAMPLES = 20_000
#: The least share of toxic documents of a term; the part of the chosen terms that may be expected to have it by chance.
SHARE, CHANCE = 0.5, 0.2
PREFIXES = (4, 6)
NEIGHBOURS, BLOCK = 15, 32
THRESHOLD = 0.7
#: Numbers of terms from which on a document counts as richer in them, and the weight of that against all its terms.
RICHNESS, RICH_WEIGHT = np.array([1, 2, 3, 4, 6, 9, 13]), 0.8
_NO_IDS = np.zeros(0, np.int64)


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all rows, and their rows."""
    starts, ends, rows = spans(~NOT_WORD[data[: bounds[-1]]], bounds)
    data = LOWER[data]
    found, of = [hash_spans(data, starts, ends)], [rows]
    for k in PREFIXES:
        long = ends - starts >= k
        found.append(hash_spans(data, starts[long], starts[long] + k, k))
        of.append(rows[long])
    return np.concatenate(found), np.concatenate(of)


def _counts(batches):
    """term, toxic, clean: documents of each class that have the term, by piece."""
    for piece in pieces(batches):
        found, of = terms(*utf8(piece.column("text")))
        label = piece.column("toxic").to_numpy().astype(np.int64)
        order = np.lexsort((of, found))
        found, of = found[order], of[order]
        new = np.concatenate([[True], (found[1:] != found[:-1]) | (of[1:] != of[:-1])])[: len(found)]
        found, of = found[new], of[new]
        key, place = np.unique(found, return_inverse=True)
        toxic = np.bincount(place, label[of], len(key)).astype(np.int64)
        both = np.bincount(place, minlength=len(key))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(toxic), pa.array(both - toxic)], names=["term", "toxic", "clean"])


def least_toxic(many: dict[int, int], seen: dict[tuple[int, int], int], toxic: int, clean: int) -> list[tuple[int, int]]:
    """(documents, least toxic documents) of the terms that are chosen.

    ``many``: numbers of terms by the documents that have them; ``seen``: by (toxic, clean) documents. The probability that a term of so many documents has so many toxic ones by chance is
    hypergeometric. Of all bounds on it, the largest is taken under which the terms expected by chance, counted over all terms, are at most the part CHANCE of those seen.
    """
    fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, toxic + clean + 1)))])
    ways = lambda a, b: fact[a] - fact[b] - fact[a - b]
    tails = {}
    for d in sorted(many):
        t = np.arange(max(int(np.ceil(SHARE * d)), d - clean, 1), min(d, toxic) + 1)
        if len(t):
            tail = np.exp(ways(toxic, t) + ways(clean, d - t) - ways(toxic + clean, d))
            tails[d] = t, np.minimum(np.cumsum(tail[::-1])[::-1], 1)
    found = [(tails[t + c][1][t - tails[t + c][0][0]], k) for (t, c), k in seen.items()]
    if not found:
        return []
    chance, terms_ = np.array(found).T
    bounds = np.unique(chance) * (1 + 1e-9)
    expected = np.zeros(len(bounds))
    for d, (_, tail) in tails.items():
        expected += many[d] * np.append(0.0, tail[::-1])[np.searchsorted(tail[::-1], bounds, "right")]
    order = np.argsort(chance)
    number = np.append(0, np.cumsum(terms_[order]))[np.searchsorted(chance[order], bounds, "right")]
    good = bounds[expected <= CHANCE * number]
    if not len(good):
        return []
    return [(d, int(t[tail <= good[-1]][0])) for d, (t, tail) in tails.items() if tail[-1] <= good[-1]]


def _vectors(chosen: np.ndarray):
    """doc_id, key, places of chosen terms and how often they occur."""

    def run(batches):
        for piece in pieces(batches):
            found, of = terms(*utf8(piece.column("text")))
            place = np.minimum(np.searchsorted(chosen, found), max(len(chosen) - 1, 0))
            hit = chosen[place] == found if len(chosen) else np.zeros(len(found), bool)
            key, counts = np.unique(of[hit] * max(len(chosen), 1) + place[hit], return_counts=True)
            row, term = np.divmod(key, max(len(chosen), 1))
            bounds = pa.array(np.searchsorted(row, np.arange(piece.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x, pa.int32())) for x in (term, counts)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("key"), *lists], names=["doc_id", "key", "terms", "counts"])

    return run


class Examples:
    """Labelled vectors with a block-max inverted index. ``rows``: (doc_id, terms, counts, label)."""

    def __init__(self, rows: list, idf: np.ndarray):
        self.idf = idf
        empty = [r[3] for r in rows if not len(r[1])]
        rows = [(r[0], *self.vector(r[1], r[2]), r[3]) for r in rows if len(r[1])]
        # examples with the same main terms lie together, so that block maxima are tight
        rows.sort(key=lambda r: (r[1][np.argsort(-r[2], kind="stable")].tolist(), r[0]))
        self.id, self.label = np.array([r[0] for r in rows], np.int64), np.array([r[3] for r in rows], float)
        self.rows = rows
        size = len(rows)
        self.base = (self.label.sum() + sum(empty) + 1) / (size + len(empty) + 2)
        self.empty_score = (sum(empty) + self.base) / (len(empty) + 1)
        self.blocks = -(-size // BLOCK)
        term = np.concatenate([r[1] for r in rows]) if rows else _NO_IDS
        weight = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0)
        at = np.repeat(np.arange(size), [len(r[1]) for r in rows])
        order = np.lexsort((at, term))
        term, self.at, self.weight = term[order], at[order], weight[order]
        self.first = np.searchsorted(term, np.arange(len(idf) + len(RICHNESS) + 1))
        self.block_of, self.block_max, self.block_first = [], [], []
        for a, b in zip(self.first[:-1], self.first[1:]):
            block, begin = np.unique(self.at[a:b] // BLOCK, return_index=True)
            self.block_of.append(block)
            self.block_max.append(np.maximum.reduceat(self.weight[a:b], begin) if b > a else np.zeros(0))
            self.block_first.append(np.append(begin, b - a) + a)
        self.steps, self.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def vector(self, term, count) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights, of length 1. How many terms a document has is a term as well."""
        term = np.asarray(term, np.int64)
        w = (1 + np.log(np.asarray(count, float))) * self.idf[term]
        w = np.append(w, RICH_WEIGHT * np.sqrt((w * w).sum()))
        return np.append(term, len(self.idf) + np.searchsorted(RICHNESS, len(term), "right") - 1), w / np.sqrt((w * w).sum())

    def nearest(self, term, weight, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above zero, ties by place."""
        bound = np.zeros(self.blocks)
        for t, w in zip(term, weight):
            bound[self.block_of[t]] += w * self.block_max[t]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score, done, least = {}, 0, 0.0
        while done < len(order) and bound[order[done]] >= least - 1e-9:
            some = order[done : done + 8]
            done += len(some)
            for t, w in zip(term, weight):
                place = np.searchsorted(self.block_of[t], some)
                inside = place < len(self.block_of[t])
                for p in place[inside][self.block_of[t][place[inside]] == some[inside]].tolist():
                    s = slice(self.block_first[t][p], self.block_first[t][p + 1])
                    for i, x in zip(self.at[s].tolist(), (w * self.weight[s]).tolist()):
                        score[i] = score.get(i, 0.0) + x
            if len(score) > k:
                least = np.partition(np.fromiter(score.values(), float, len(score)), -k)[-k]
        score.pop(without, None)
        at, value = np.fromiter(score, np.int64, len(score)), np.fromiter(score.values(), float, len(score))
        value = np.minimum(np.round(value, 12), 1.0)
        best = np.lexsort((at, -value))[:k]
        return at[best], value[best]

    def vote(self, at, value) -> float:
        """Share of toxic examples, by squared similarity, with one vote for the base rate shared out by how near they are."""
        w = value**2
        rest = 0.25
        return float(((w * self.label[at]).sum() + rest * self.base) / (w.sum() + rest))

    def calibrate(self, k: int) -> None:
        """Isotonic regression of labels on votes of the examples, each without itself."""
        votes = np.array([self.vote(*self.nearest(r[1], r[2], k, i)) for i, r in enumerate(self.rows)])
        if not len(votes):
            return
        order = np.argsort(votes, kind="stable")
        means, sizes, tops = [], [], []
        for v, y in zip(votes[order], self.label[order]):
            means.append(y)
            sizes.append(1.0)
            tops.append(v)
            while len(means) > 1 and means[-2] >= means[-1]:
                m, n = means.pop(), sizes.pop()
                means[-1], sizes[-1] = (means[-1] * sizes[-1] + m * n) / (sizes[-1] + n), sizes[-1] + n
                tops[-2:] = [v]
        self.steps, self.levels = np.array(tops), (np.array(means) * np.array(sizes) + self.base) / (np.array(sizes) + 1)

    def score(self, term, count, k: int) -> tuple[float, np.ndarray, np.ndarray]:
        if not len(term):
            return self.empty_score, _NO_IDS, np.zeros(0)
        at, value = self.nearest(*self.vector(term, count), k)
        if not len(at):
            return self.base, _NO_IDS, np.zeros(0)
        vote = self.vote(at, value)
        step = min(int(np.searchsorted(self.steps, vote)), len(self.levels) - 1)
        return float(np.clip(self.levels[step], 0, 1)), self.id[at], value


def _scores(examples: Examples, k: int):
    def run(batches):
        for batch in batches:
            score, ids, values, memory = [], [], [], {}
            for t, c in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                key = (*t, -1, *c)
                if key not in memory:
                    memory[key] = examples.score(t, c, k)
                s, i, v = memory[key]
                score.append(s)
                ids.append(i[:3])
                values.append(v[:3])
            arrays = [batch.column("doc_id"), batch.column("key"), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "score", "examples", "similarities"])

    return run


def toxicity(documents: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, key, held_out, score, predicted, examples, similarities of each document: the last two are its three nearest examples, as evidence;
    key is a hash of the text that tells rows of one doc_id apart.

    Labels are learned only from rows of ``labels`` (doc_id, toxic) that are not held out, and of these from the ``examples`` with the smallest hash of doc_id; null labels and ids are
    left out, of repeated labels the largest counts. Null and empty texts and texts without any chosen term get the rate of such examples. Without
    any label the score is 0.5. Repeated rows are scored each. Labels, lang, source and doc_id are no input of a score.
    """
    spark = documents.sparkSession
    docs = columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    part = min(1.0, (examples + 10 * examples**0.5 + 100) / max(known.count(), 1))  # leaves enough rows, and few for the last sort
    low = F.xxhash64("doc_id").cast("double") < F.lit(part * 2.0**64 - 2.0**63)
    sample = known.where(low | F.lit(part == 1.0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    sample = stored(sample, "sample")  # at most ``examples`` rows of two numbers
    learned = stored(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic"), "examples")
    learned = learned.where("text IS NOT NULL")
    toxic, clean = (x or 0 for x in learned.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    counts = learned.repartition(F.xxhash64("doc_id")).mapInArrow(_counts, "term long, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = stored(counts.withColumn("documents", F.col("toxic") + F.col("clean")), "counts")
    many = {r.documents: r.terms for r in counts.groupBy("documents").agg(F.count("*").alias("terms")).collect()}  # at most a row for each example
    shared = counts.where((F.col("toxic") > 0) & (F.col("toxic") >= SHARE * F.col("documents")))
    seen = {(r.toxic, r.clean): r.terms for r in shared.groupBy("toxic", "clean").agg(F.count("*").alias("terms")).collect()}  # few: most terms of a mostly toxic use are rare
    least = spark.createDataFrame(least_toxic(many, seen, int(toxic), int(clean)), "documents long, least long")
    chosen = shared.join(F.broadcast(least), "documents").where("toxic >= least").select("term").collect()  # some of the terms of toxic examples
    chosen = np.sort(np.array([r.term for r in chosen], np.int64).view(np.uint64))
    vectors = stored(docs.mapInArrow(_vectors(chosen), "doc_id long, key long, terms array<int>, counts array<int>"), "vectors")
    total = vectors.count()
    frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each chosen term
    idf = np.full(len(chosen), np.log(1 + total))
    for r in frequency:
        idf[r.term] = np.log((1 + total) / (1 + r["count"])) + 1e-6
    known = vectors.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min(F.struct("key", "terms", "counts", "toxic")).alias("r"))
    rows = known.select("doc_id", "r.terms", "r.counts", "r.toxic").orderBy("doc_id").collect()  # a row for each example
    index = Examples([tuple(r) for r in rows], idf)
    index.calibrate(NEIGHBOURS)
    kinds = "doc_id long, key long, score double, examples array<long>, similarities array<double>"
    scored = vectors.mapInArrow(_scores(index, NEIGHBOURS), kinds)
    return scored.select("doc_id", "key", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "examples", "similarities")
