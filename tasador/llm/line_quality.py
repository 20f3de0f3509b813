"""Quality of documents from their lines, labelled good or bad by a linear-chain conditional random field.

A line is described by binned shares and counts (case, punctuation, repeated words, symbols, lengths, a copy of the line in the same document), and sees those of the line before and the line
after it. Labels exist for documents only, so the field learns from "all lines are good" for good documents and "not all lines are good" for bad ones: the likelihood of either
follows from the same forward sums. That alone leaves open which lines are bad, so a second, piecewise term asks each line's own features for its document's label: features that only bad
documents have then speak against the lines that have them, and lines of any document stay good. Forward and backward sums of all documents of a batch are computed at once, by doubling. A document's raw quality is the mean of its lines' marginals, each weighted
by its length; a logistic curve over the labelled documents turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored
from tasador.llm.text import BLANK, LOWER, hash_spans, mix, pieces, spans, utf8

#: Labelled rows that are learned from: those with the smallest hash of doc_id.
EXAMPLES = 20_000
#: Most steps of the optimiser, pairs of steps that it remembers, and the weight of the squared parameters against one document.
ROUNDS, MEMORY, PENALTY = 25, 8, 1.0
THRESHOLD = 0.3
SHARES = np.array([1e-9, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 0.95])
SIZES = np.array([2, 3, 4, 5, 6, 8, 10, 15, 30, 100, 300])
BINS = 12

UPPER, LETTER, DIGIT, MARK, WIDE = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = True
LETTER[[*range(65, 91), *range(97, 123)]] = True
DIGIT[48:58] = True
MARK[33:127] = ~(LETTER | DIGIT)[33:127]
WIDE[128:] = True
FEATURES = 15


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all features of the lines of a text column, rows, starts and ends of the lines in bytes of their text. Empty lines are none."""
    data, bounds = utf8(column)
    text = data[: bounds[-1]]
    starts, ends, rows = spans(text != 10, bounds)
    size, n = (ends - starts).astype(float), len(starts)

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(float)

    word_starts, word_ends, _ = spans(~BLANK[text], bounds)
    line = np.searchsorted(starts, word_starts, "right") - 1
    words = np.bincount(line, minlength=n).astype(float)
    share = lambda x, of: np.searchsorted(SHARES, x / np.maximum(of, 1), "right")
    many = lambda x: np.searchsorted(SIZES, x, "right")
    of_words = lambda flags: np.bincount(line[flags], minlength=n).astype(float)
    hashes = hash_spans(LOWER[data], word_starts, word_ends)
    again = np.zeros(len(line), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    first = np.zeros(len(line), bool)
    first[np.unique(mix(line.astype(np.uint64)) ^ hashes, return_index=True)[1]] = True
    plain = np.concatenate([[0], np.cumsum(LETTER[text] | DIGIT[text] | WIDE[text], dtype=np.int64)])
    capital = np.concatenate([[0], np.cumsum(UPPER[text], dtype=np.int64)])
    letters = np.concatenate([[0], np.cumsum(LETTER[text], dtype=np.int64)])
    of = lambda total: total[word_ends] - total[word_starts]
    twin = np.zeros(len(text), bool)
    twin[1:] = MARK[text[1:]] & (text[1:] == text[:-1])
    whole = np.stack([rows.astype(np.uint64), hash_spans(data, starts, ends)], 1) if n else np.zeros((0, 2), np.uint64)
    _, place, copies = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
    last = text[ends - 1] if n else text[:0]
    head = text[starts] if n else text[:0]
    kind = lambda b: UPPER[b] * 1 + (LETTER[b] & ~UPPER[b]) * 2 + DIGIT[b] * 3 + MARK[b] * 4 + WIDE[b] * 5 + (b == 46) * 2
    found = np.stack([
        share(per_line(UPPER[text]), per_line(LETTER[text])), share(per_line(DIGIT[text]), size), share(per_line(MARK[text]), size), share(per_line(twin), size),
        share(per_line(WIDE[text]), size), share(per_line(BLANK[text]), size), share(of_words(again), words), share(of_words(first), words),
        share(of_words(of(plain) == 0), words), share(of_words((of(capital) == of(letters)) & (of(letters) > 1)), words),
        many(words), many(per_line(~BLANK[text]) / np.maximum(words, 1)), many(copies[place.ravel()]), kind(head), kind(last),
    ], 1).astype(np.uint8)
    return found, rows, starts - bounds[rows], ends - bounds[rows]


#: Places of the parameters: those of the line, of the line before, of the line after, of the chain (start, then from bad and from good to bad and good), and one for all lines.
TABLE = FEATURES * BINS
CHAIN, BIAS, PARAMETERS = 3 * TABLE, 3 * TABLE + 6, 3 * TABLE + 7
_AT = np.arange(FEATURES) * BINS


def _sums(w: np.ndarray, places: np.ndarray, shift: int) -> np.ndarray:
    return w[shift : shift + TABLE][places].sum(1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices of logarithms."""
    return np.logaddexp(a[:, :, 0:1] + b[:, 0:1, :], a[:, :, 1:2] + b[:, 1:2, :])


def _products(steps: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each line the product of the matrices from the first line of its document on; rounds: the logarithm of the longest document."""
    out, step = steps.copy(), 1
    while len(place) and step <= place.max():
        at = np.flatnonzero(place >= step)
        out[at] = _join(out[at - step], out[at])
        step *= 2
    return out


class Chains:
    """The lines of some documents, one after the other, all with at least one. ``place``: number of a line in its document, ``left``: lines after it."""

    def __init__(self, bins: np.ndarray, doc: np.ndarray, docs: int):
        self.places, self.doc, self.docs = bins.astype(np.int64) + _AT, doc, docs
        lengths = np.bincount(doc, minlength=docs)
        self.last = np.cumsum(lengths) - 1
        self.first = self.last - lengths + 1
        self.place = np.arange(len(doc)) - np.repeat(self.first, lengths)
        self.left = np.repeat(self.last, lengths) - np.arange(len(doc))
        self.inner = np.flatnonzero(self.place > 0)

    def odds(self, w: np.ndarray) -> np.ndarray:
        """Log odds of good of each line, by its own features and those of its neighbours."""
        out = w[BIAS] + _sums(w, self.places, 0)
        out[self.inner] += _sums(w, self.places[self.inner - 1], TABLE)
        out[self.inner - 1] += _sums(w, self.places[self.inner], 2 * TABLE)
        return out

    def sums(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Odds, forward and backward sums (bad, good) of each line, and the sum over all labellings of each document with lines."""
        odds = self.odds(w)
        steps = np.zeros((len(odds), 2, 2))
        steps[:] = w[CHAIN + 2 : CHAIN + 6].reshape(2, 2)
        steps[self.first] = w[CHAIN : CHAIN + 2]
        steps[:, :, 1] += odds[:, None]
        forward = _products(steps, self.place)[:, 0, :]
        # backwards: matrices of the lines after each, transposed, multiplied from the last line on
        after = np.zeros_like(steps)
        after[self.inner - 1] = steps[self.inner].transpose(0, 2, 1)
        after[self.last] = np.array([[0.0, -np.inf], [-np.inf, 0.0]])
        with np.errstate(invalid="ignore"):
            back = _products(after[::-1], self.left[::-1])[::-1]
        backward = np.logaddexp(back[:, 0, :], back[:, 1, :])
        return odds, forward, backward, np.logaddexp(forward[self.last, 0], forward[self.last, 1])

    def marginals(self, w: np.ndarray) -> np.ndarray:
        """Probability of good of each line."""
        _, forward, backward, total = self.sums(w)
        return np.exp(np.minimum(forward[:, 1] + backward[:, 1] - total[self.doc], 0))

    def pieces(self, w: np.ndarray, good: np.ndarray, sizes: np.ndarray) -> tuple[float, np.ndarray]:
        """Log likelihood of each line's document label by the line's own features, a mean over the bytes of the document, and its gradient."""
        own = np.clip(w[BIAS] + _sums(w, self.places, 0), -500, 500)
        part, target = sizes / np.bincount(self.doc, sizes, self.docs)[self.doc], good[self.doc]
        value = -(part * np.log1p(np.exp(np.where(target, -own, own)))).sum()
        by_line, gradient = part * (target - 1 / (1 + np.exp(-own))), np.zeros(PARAMETERS)
        gradient[:TABLE] = np.bincount(self.places.ravel(), np.repeat(by_line, FEATURES), TABLE)
        gradient[BIAS] = by_line.sum()
        return float(value), gradient

    def likelihood(self, w: np.ndarray, good: np.ndarray) -> tuple[float, np.ndarray]:
        """Log likelihood of the documents' labels, and its gradient. ``good``: label of each document."""
        odds, forward, backward, total = self.sums(w)
        of = self.doc
        chain = w[CHAIN + 2 : CHAIN + 6].reshape(2, 2)
        lines = np.bincount(of, minlength=len(total))
        all_good = np.bincount(of, odds, len(total)) + w[CHAIN + 1] + (lines - 1) * chain[1, 1]
        log_q = np.minimum(all_good - total, -1e-9)
        value = np.where(good, log_q, np.log(-np.expm1(log_q))).sum()
        pull = np.where(good, 1.0, -1 / np.expm1(-log_q))
        p_good = np.exp(np.minimum(forward[:, 1] + backward[:, 1] - total[of], 0))
        by_line = pull[of] * (1 - p_good)
        gradient = np.zeros(PARAMETERS)
        for shift, where, to in ((0, slice(None), slice(None)), (TABLE, self.inner - 1, self.inner), (2 * TABLE, self.inner, self.inner - 1)):
            places = self.places[where]
            gradient[shift : shift + TABLE] = np.bincount(places.ravel(), np.repeat(by_line[to], FEATURES), TABLE)
        gradient[BIAS] = by_line.sum()
        gradient[CHAIN : CHAIN + 2] = [-(pull * (1 - p_good[self.first])).sum(), (pull * (1 - p_good[self.first])).sum()]
        i = self.inner
        for a in (0, 1):
            for b in (0, 1):
                both = np.exp(np.minimum(forward[i - 1, a] + chain[a, b] + b * odds[i] + backward[i, b] - total[of[i]], 0))
                gradient[CHAIN + 2 + 2 * a + b] = (pull[of[i]] * ((a & b) - both)).sum()
        return float(value), gradient


def minimise(value_of: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search; ``value_of`` gives value and gradient."""
    w, pairs = start, []
    value, slope = value_of(w)
    for _ in range(rounds):
        step, kept = slope.copy(), []
        for s, y in reversed(pairs):
            a = s @ step / (s @ y)
            kept.append(a)
            step -= a * y
        step *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, float(np.abs(slope).sum()))
        for (s, y), a in zip(pairs, reversed(kept)):
            step += (a - y @ step / (s @ y)) * s
        length = 1.0
        for _ in range(12):
            new = w - length * step
            new_value, new_slope = value_of(new)
            if new_value <= value - 1e-4 * length * (slope @ step):
                break
            length /= 2
        else:
            break
        s, y = new - w, new_slope - slope
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-MEMORY:]
        done = abs(value - new_value) <= 1e-4 * max(abs(value), 1e-3)
        w, value, slope = new, new_value, new_slope
        if done:
            break
    return w


def _chains(bins: pa.Array) -> tuple[Chains, np.ndarray]:
    """The documents of a column of packed bins that have lines, and which they are."""
    packed = bins.to_pylist()
    lines = np.array([len(b) // FEATURES for b in packed], np.int64)
    some = np.flatnonzero(lines)
    flat = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, FEATURES)
    return Chains(flat, np.repeat(np.arange(len(some)), lines[some]), len(some)), some


def _sizes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sizes").to_pylist()), "<i4")


def _learn(w: np.ndarray):
    def run(batches):
        value, gradient = 0.0, np.zeros(PARAMETERS)
        for batch in batches:
            chains, some = _chains(batch.column("bins"))
            if len(some):
                good, sizes = batch.column("good").to_numpy()[some] == 1, _sizes(batch)
                for v, g in (chains.likelihood(w, good), chains.pieces(w, good, sizes)):
                    value, gradient = value + v, gradient + g
        yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([gradient.tobytes()], pa.binary())], names=["value", "gradient"])

    return run


def packed_features(documents: DataFrame) -> DataFrame:
    """doc_id, key, bins and sizes of the lines of each document, as bytes."""

    def run(batches):
        for piece in pieces(batches):
            bins, rows, starts, ends = line_features(piece.column("text"))
            cut = np.searchsorted(rows, np.arange(piece.num_rows + 1))
            sizes = (ends - starts).astype("<i4")
            packed = [[x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])] for x in (bins, sizes)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("key"), *[pa.array(x, pa.binary()) for x in packed]], names=["doc_id", "key", "bins", "sizes"])

    docs = columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return docs.mapInArrow(run, "doc_id long, key long, bins binary, sizes binary")


def raw_quality(p: np.ndarray, sizes: np.ndarray, of: np.ndarray, docs: int) -> np.ndarray:
    """Log odds of the mean of line marginals, each weighted by the line's length."""
    q = np.bincount(of, p * sizes, docs) / np.maximum(np.bincount(of, sizes, docs), 1)
    q = np.clip(q, 1e-6, 1 - 1e-6)
    return np.log(q / (1 - q))


@dataclass
class LineModel:
    """Parameters of the field, the logistic curve over raw quality, and the rate of good documents."""

    weights: np.ndarray
    slope: float
    offset: float
    base: float

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -30, 30)))


def fit_curve(raw: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, with two fictitious documents of either label at the mean."""
    x = np.concatenate([raw, np.full(2, raw.mean())])
    y = np.concatenate([good, [0.0, 1.0]])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        s = p * (1 - p)
        hessian = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(hessian, [((y - p) * x).sum() - 1e-2 * a, (y - p).sum()])
        scale = min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        a, b = a + scale * step[0], b + scale * step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 0.0), b


def learn(documents: DataFrame, labels: DataFrame, examples: int = EXAMPLES, rounds: int = ROUNDS) -> LineModel:
    """A model from at most ``examples`` labelled documents; each step of the optimiser is one job over their stored features, and each task sends one gradient."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
    known = known.where(F.col("good").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = stored(known.groupBy("doc_id").agg(F.min("good").alias("good")), "labels")
    part = min(1.0, (examples + 10 * examples**0.5 + 100) / max(known.count(), 1))  # leaves enough rows, and few for the last sort
    low = F.xxhash64("doc_id").cast("double") < F.lit(part * 2.0**64 - 2.0**63)
    sample = stored(known.where(low | F.lit(part == 1.0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples), "sample")  # at most ``examples`` rows of two numbers
    chosen = columns(documents, "doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    packed = packed_features(chosen).groupBy("doc_id").agg(F.min(F.struct("key", "bins", "sizes")).alias("r"))  # of repeated rows one
    packed = stored(packed.join(F.broadcast(sample), "doc_id").select("r.*", "good"), "features")
    n, good = packed.agg(F.count("*"), F.sum("good")).first()
    base = ((good or 0) + 1) / (n + 2)
    if not n or good in (0, n):
        return LineModel(np.zeros(PARAMETERS), 0.0, float(np.log(base / (1 - base))), base)

    def value_of(w: np.ndarray) -> tuple[float, np.ndarray]:
        parts = packed.mapInArrow(_learn(w), "value double, gradient binary").collect()  # one row for each task
        value = -sum(r.value for r in parts) / n + 0.5 * PENALTY / n * float(w @ w)
        return value, -np.sum([np.frombuffer(r.gradient) for r in parts], 0) / n + PENALTY / n * w

    weights = minimise(value_of, np.zeros(PARAMETERS), rounds)

    def raw(batches):
        for batch in batches:
            chains, some = _chains(batch.column("bins"))
            if len(some):
                value = raw_quality(chains.marginals(weights), _sizes(batch), chains.doc, chains.docs)
                yield pa.RecordBatch.from_arrays([pa.array(value), batch.column("good").take(pa.array(some))], names=["raw", "good"])

    found = packed.mapInArrow(raw, "raw double, good int").collect()  # at most ``examples`` pairs of numbers
    if not found:
        return LineModel(weights, 0.0, float(np.log(base / (1 - base))), base)
    return LineModel(weights, *fit_curve(np.array([r.raw for r in found]), np.array([float(r.good) for r in found])), base)


def quality(documents: DataFrame, labels: DataFrame, examples: int = EXAMPLES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, key (a hash of the text), held_out, score, predicted, n_lines and n_bad_lines of each document.

    Labels are learned only from rows of ``labels`` (doc_id, quality) that are not held out, and of these from the ``examples`` with the smallest hash of doc_id; null labels and ids are left
    out, of repeated labels the smallest counts, of repeated documents one. Null and empty texts and texts of line feeds only have no line and get the rate of good documents; without
    any label, or with one kind only, all get it. Repeated rows are scored each, a null doc_id is never held out. Labels, lang, source and doc_id are no input of a score.
    """
    return score_documents(documents, learn(documents, labels, examples, rounds))


def score_documents(documents: DataFrame, model: LineModel) -> DataFrame:
    """The result of :func:`quality` by a learned model; one pass over the texts."""

    def run(batches):
        for piece in pieces(batches):
            bins, rows, starts, ends = line_features(piece.column("text"))
            score, bad = np.full(piece.num_rows, model.base), np.zeros(piece.num_rows, np.int64)
            if len(rows):
                some, doc = np.unique(rows, return_inverse=True)
                p = Chains(bins, doc, len(some)).marginals(model.weights)
                score[some] = model.scores(raw_quality(p, ends - starts, doc, len(some)))
                bad = np.bincount(rows, p < 0.5, piece.num_rows).astype(np.int64)
            lines = np.bincount(rows, minlength=piece.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("key"), pa.array(score), pa.array(lines), pa.array(bad)], names=["doc_id", "key", "score", "n_lines", "n_bad_lines"])

    docs = columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    scored = docs.mapInArrow(run, "doc_id long, key long, score double, n_lines long, n_bad_lines long")
    return scored.select("doc_id", "key", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_lines", "n_bad_lines")


def labelled_lines(documents: DataFrame, model: LineModel) -> DataFrame:
    """doc_id, key, line (from 0, empty lines not counted), start and end (UTF-8 bytes), p_good and good of every line of every document."""

    def run(batches):
        for piece in pieces(batches):
            bins, rows, starts, ends = line_features(piece.column("text"))
            if not len(rows):
                continue
            _, doc = np.unique(rows, return_inverse=True)
            chains = Chains(bins, doc, int(doc[-1]) + 1)
            p, at = chains.marginals(model.weights), pa.array(rows)
            arrays = [piece.column("doc_id").take(at), piece.column("key").take(at), *map(pa.array, (chains.place, starts, ends, p, p >= 0.5))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "line", "start", "end", "p_good", "good"])

    docs = columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return docs.mapInArrow(run, "doc_id long, key long, line long, start long, end long, p_good double, good boolean")
