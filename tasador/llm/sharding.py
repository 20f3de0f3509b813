"""Shards by jump consistent hashing.

A key's shard follows from the key and the number of shards alone, and with one shard more only the keys of the new shard move.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored
from tasador.llm.text import mix

#: The multiplier of the linear congruential generator that jump hashing draws from; fixed, as shards depend on it.
STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. A key jumps from shard to larger shard until it would leave the range; about ln(shards) jumps."""
    state, at, ahead = keys.astype(np.uint64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        at[active] = ahead[active]
        state[active] = state[active] * STEP + np.uint64(1)
        draw = ((state[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[active] = ((at[active] + 1) * (2147483648.0 / draw)).astype(np.int64)
        active = active[ahead[active] < shards]
    return at


def _shards(shards: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy().astype(np.int64)
            keys = mix(ids.view(np.uint64))  # so that neighbouring ids are unrelated
            yield batch.append_column("shard", pa.array(jump_hash(keys, shards), pa.int32())).append_column("grown_shard", pa.array(jump_hash(keys, shards + 1), pa.int32()))

    return run


def _places(batches):
    """Number the rows of each shard within the task, in the order they come."""
    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        place = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            place[mine] = seen.get(s, 0) + np.arange(len(mine))
            seen[s] = seen.get(s, 0) + len(mine)
        yield batch.append_column("task", pa.array(np.full(len(shard), task, np.int32))).append_column("place", pa.array(place))


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each document, under the law ``key``.

    size is the UTF-8 length plus 1 (null text: 1), text_crc32 that of the UTF-8 bytes (null: as empty). A null doc_id counts as key -1.
    Repeated rows go to the same shard, each with a slot of its own. Slots follow doc_id, size and checksum: rows are sorted in parallel by ranges, numbered
    within each task, and moved up by the counts of the tasks before. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = columns(documents, "doc_id", "text").select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    kind = "doc_id long, size long, text_crc32 long"
    keyed = rows.mapInArrow(_shards(shards), f"{kind}, shard int, grown_shard int")
    order = ["shard", "doc_id", "size", "text_crc32"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.mapInArrow(_places, f"{kind}, shard int, grown_shard int, task int, place long"), "places")
    counts = placed.groupBy("shard", "task").agg(F.count("*").alias("rows"))  # a row for each task and shard in it
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("shard", "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("moved"))
    return placed.join(moved, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("moved") + F.col("place")).alias("slot"), "grown_shard"
    )
