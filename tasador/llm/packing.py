"""Packing documents into token sequences of bounded length.

Pieces of documents are dealt at random into groups of bounded size, and each group is packed by the sum-of-squares rule: a piece goes to the open
sequence for which the sum over gaps of the squared number of open sequences with that gap becomes smallest. All pieces of a group are known, so they are taken by falling size. A new sequence is opened only where no open one
has room: weighing a new one as well, as the rule does for pieces that come one by one, leaves sequences open for pieces that never come (README has the numbers of sequences).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored
from tasador.llm.spancache import SpanCache, parts
from tasador.llm.text import pieces, utf8
from tasador.llm.word_bpe import WordEncoder

CAPACITY = 2048
#: Pieces packed together, on average. More pack a little better; a group is one task's work.
GROUP = 16_384


def sum_of_squares(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece. Pieces are taken by falling size; of gaps with the same sum the smallest is taken."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    open_ = [[] for _ in range(capacity + 1)]
    sequence, offset, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        if s < capacity:
            # change of the sum if the gap s + k becomes k; a filled sequence counts no more
            change = np.where(counts[s:capacity] > 0, 2 * (counts[: capacity - s] - counts[s:capacity]) + 2, np.iinfo(np.int64).max)
            change[0] -= 2 * counts[0] + 1 if counts[s] else 0
            k = int(change.argmin())
            gap = s + k if counts[s + k] else capacity
        else:
            gap = capacity
        if gap == capacity:
            at, used = used, used + 1
        else:
            at = open_[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i] = at, capacity - gap
        if gap > s:
            open_[gap - s].append(at)
            counts[gap - s] += 1
    return sequence, offset


def piece_batches(path: str, capacity: int, with_ids: bool):
    """Pieces of each document: ids of its words, the end id 0, cut only if longer than a sequence."""

    def run(batches):
        cache = SpanCache(WordEncoder(path))
        for batch in pieces(batches):
            data, bounds = utf8(batch.column("text"))
            starts, ends, rows = parts(data, bounds, lead=False)
            ids, lengths = cache.ids(data, starts, ends)
            cuts = np.concatenate([[0], np.cumsum(np.bincount(rows, lengths, len(bounds) - 1).astype(np.int64))])
            out = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                own = np.append(ids[a:b], np.uint32(0)).astype("<u4")
                for p, start in enumerate(range(0, len(own), capacity)):
                    raw = own[start : start + capacity].tobytes()
                    out.append((doc, p, start, len(raw) // 4, zlib.crc32(raw), *((np.frombuffer(raw, "<i4"),) if with_ids else ())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=[n for n, _ in zip(names, out[0])])

    return run


def token_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of all pieces. Words between ASCII white space are encoded apart,
    which gives the ids of the whole text for a tokenizer that drops white space. A null text is empty: its only id is the end."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return columns(documents, "doc_id", "text").mapInArrow(piece_batches(path, capacity, with_ids), schema)


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = sum_of_squares(group.column("length").to_numpy(), capacity)
        sequence += int(group.column("group")[0].as_py()) << 32
        return group.drop_columns(["group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(pieces_: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to the pieces (columns of :func:`token_pieces`). An empty table gives an empty one; repeated rows are packed each."""
    pieces_ = stored(pieces_, "pieces")
    groups = max(1, round(pieces_.count() / group))
    key = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    dealt = pieces_.withColumn("group", key)
    return dealt.groupBy("group").applyInArrow(_pack(capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Placement of every piece of every document."""
    return pack(token_pieces(documents, path, capacity), capacity)


def _join_pieces(group: pa.Table) -> pa.Table:
    group = group.sort_by("offset")
    ids = np.concatenate([np.asarray(x, np.int32) for x in group.column("ids").to_pylist()])
    return pa.table({"sequence_id": group.column("sequence_id")[:1], "ids": pa.array([ids], pa.list_(pa.int32()))})


def sequences(documents: DataFrame, placement: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids. A sequence is bounded, so each is put together in one place."""
    full = token_pieces(documents, path, capacity, True).drop("start", "length")
    placed = placement.select("doc_id", "piece", "ids_crc32", "sequence_id", "offset").join(full, ["doc_id", "piece", "ids_crc32"])
    return placed.groupBy("sequence_id").applyInArrow(_join_pieces, "sequence_id long, ids array<int>")
