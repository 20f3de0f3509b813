"""Blocks of vectors and of queries, for searches of a query set against all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored

#: Rows of a block of candidates and of a block of queries.
ROWS, QUERIES = 16_384, 512
EVERY = 20


def usable_vectors(embeddings: DataFrame, not_zero: bool = False) -> DataFrame:
    """vec_id and embedding as doubles, of the vectors that can be compared.

    Left out: null ids, null and empty vectors, those with a null or non-finite component (and, if asked for, zero vectors), and those whose size is not
    the most frequent one (of equally frequent ones the largest).
    """
    x = F.col("embedding")
    rows = columns(embeddings, "vec_id", "embedding").select("vec_id", x.cast("array<double>").alias("embedding"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & fine)
    if not_zero:
        rows = rows.where(F.exists(x, lambda v: v != 0.0))
    rows = stored(rows, "vectors")
    sizes = rows.groupBy(F.size(x).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size(x) == F.lit(sizes.size if sizes else 0))


def blocks(vectors: DataFrame, rows: int, total: int, pack: Callable) -> DataFrame:
    """block, ids, data: about ``rows`` vectors in each block, by vec_id; data is what ``pack`` makes of their matrix."""
    number = max(1, -(-total // rows))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids = table.column("vec_id").to_numpy().astype("<i8")
        matrix = table.column("embedding").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        return pa.table({"block": table.column("block")[:1], "ids": pa.array([ids.tobytes()], pa.binary()), "data": pa.array([pack(matrix)], pa.binary())})

    # by place, not by id: rows of one id then spread as well
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(number)).cast("int"))
    return dealt.groupBy("block").applyInArrow(run, "block int, ids binary, data binary")


def search(vectors: DataFrame, k: int, kind: str, index: Callable, query: Callable, best: Callable[..., Iterator]) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found for each query (a row whose vec_id is divisible by ``EVERY``) over all blocks of rows.

    ``index`` and ``query`` pack the matrix of a block; ``best(query_ids, queries, ids, data)`` yields for each query of a pair of blocks its number and up to k
    places in the block with their scores. Each block of rows is sent once for each block of queries; only the best k leave a pair of blocks, and these are merged by query.
    """
    asks = F.pmod("vec_id", F.lit(EVERY)) == 0
    total, asked = vectors.agg(F.count("*"), F.count(F.when(asks, 1))).first()
    asking = stored(blocks(vectors.where(asks), QUERIES, asked, query), "queries")
    data = stored(blocks(vectors, ROWS, total, index), "blocks")
    number = max(1, -(-total // ROWS))
    pairs = asking.select(F.col("block").alias("asking"), F.col("ids").alias("query_ids"), F.col("data").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("block"))
    score = pa.int64() if kind == "long" else pa.float64()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, qids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
                first = row["asking"] << 32  # each query row has a number of its own, as rows of one vec_id are queries of their own
                found = [(np.full(len(at), first + i), np.full(len(at), qids[i]), ids[at], s) for i, at, s in best(qids, row["queries"], ids, row["data"])]
                if found:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), score)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*found), kinds)], names=["query", "query_id", "vec_id", "score"])

    spread = pairs.join(data, "block").repartition("asking", "block")
    met = spread.mapInArrow(run, f"query long, query_id long, vec_id long, score {kind}")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def others(query_id: int, ids: np.ndarray) -> np.ndarray:
    """Which rows are not the query's own."""
    keep = np.ones(len(ids), bool)
    keep[np.searchsorted(ids, query_id) : np.searchsorted(ids, query_id, "right")] = False
    return keep
