"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. A vector is represented by the order of the pivots by nearness. Each pivot has an inverted file with its place in the
order of every row of the block. The footrule distance of a query to all rows, the sum over pivots of the differences of places, is added up file by file from the query's
nearest pivot on. The rows with the smallest distance are reranked by the exact inner product.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.vectors import others, search, usable_vectors

#: Pivots: the rows with the smallest hash of vec_id, a bounded sample for any input.
PIVOTS = 128
#: Part of a block's rows that is reranked, and the least number. Recall is measured in the README.
RERANKED, LEAST = 0.12, 512


def places(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The place of each pivot (row) in the order of each vector (column), nearest first."""
    near = np.argsort(-(matrix @ pivots.T), axis=1, kind="stable")
    out = np.empty(near.shape, np.int16)
    np.put_along_axis(out, near, np.arange(near.shape[1], dtype=np.int16)[None], 1)
    return np.ascontiguousarray(out.T)


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in doubles, component after component: equal vectors get equal scores."""
    out = np.zeros(len(rows))
    for d in range(len(query)):
        out += rows[:, d] * query[d]
    return out


def best_of(pivots: np.ndarray, k: int, reranked: float):
    m, size = pivots.shape

    def best(query_ids, queries, ids, data):
        files = np.frombuffer(data, np.int16, m * len(ids)).reshape(m, -1)
        rows = np.frombuffer(data, "<f8", offset=2 * m * len(ids)).reshape(len(ids), size)
        asked = np.frombuffer(queries, "<f8").reshape(len(query_ids), size)
        own = places(asked, pivots)
        for i, q in enumerate(asked):
            distance = np.zeros(len(ids), np.int16)  # m * m / 2 at most
            for p in np.argsort(own[:, i], kind="stable"):
                distance += np.abs(files[p] - own[p, i])
            at = np.flatnonzero(others(query_ids[i], ids))
            n = max(LEAST, k, int(len(at) * reranked))
            if len(at) > n:
                at = at[np.argpartition(distance[at].astype(np.int64) * len(ids) + at, n - 1)[:n]]  # of equal ones the smaller vec_id
            score = inner(rows[at], q)
            order = np.lexsort((ids[at], -score))[:k]
            yield i, at[order], score[order]

    return best


def nearest(embeddings: DataFrame, k: int = 20, pivots: int = PIVOTS, reranked: float = RERANKED) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found with the largest inner product for each query, ties by vec_id.

    Queries are the rows whose vec_id is divisible by 20; rows of the query's own vec_id are no candidates. Null and zero vectors and those with null or non-finite components
    take no part; two rows of one divisible vec_id are two queries, each with a list of its own. Every usable row is indexed; only the pivots are a sample. An empty table gives no rows.
    """
    vectors = usable_vectors(embeddings, not_zero=True)
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(pivots).select("embedding").collect()
    chosen = np.array([r.embedding for r in sample], float).reshape(len(sample), len(sample[0].embedding) if sample else 0)
    return search(vectors, k, "double", lambda m: places(m, chosen).tobytes() + np.ascontiguousarray(m, "<f8").tobytes(), lambda m: np.ascontiguousarray(m, "<f8").tobytes(), best_of(chosen, k, reranked))
