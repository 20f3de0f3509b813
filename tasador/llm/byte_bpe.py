"""Byte-level BPE: texts to token ids and back.

Two tiers. A minimal perfect hash over the vocabulary finds pre-tokens that are whole tokens, for all pre-tokens at once. The others
are merged pair by pair: bytes are a linked list, and a heap holds neighbouring parts whose union is a token, lowest rank first.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tasador.llm.scratch import columns
from tasador.llm.spancache import SpanCache, parts
from tasador.llm.text import U64, gather, hash_spans, mix, pieces, utf8

#: What \s means to the tokenizer's own regular expressions: Unicode White_Space.
WHITE = r"\t-\r \x85\xa0  -     　"


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: a place below their number for each key.

    Level by level, keys that have a slot to themselves stay; the others go on to the next level.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, base = [], 0
        while len(keys):
            size, seed = U64(2 * len(keys) + 1), mix(np.array([len(self.levels)], U64))[0]
            slot = (mix(keys + seed) % size).astype(np.int64)
            alone = np.bincount(slot, minlength=int(size)) == 1
            self.levels.append((size, seed, alone, (np.cumsum(alone) - 1 + base).astype(np.int32)))
            base, keys = base + int(alone.sum()), keys[~alone[slot]]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; for strangers any place or -1."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for size, seed, alone, place in self.levels:
            slot = (mix(keys[open_] + seed) % size).astype(np.int64)
            hit = alone[slot]
            out[open_[hit]] = place[slot[hit]]
            open_ = open_[~hit]
        return out


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: the neighbours with the lowest rank, the leftmost of equals, become one until none can."""
    n = len(token)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(token[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # a part of it is gone
        end[i], end[j] = stop, 0
        before[stop] = i
        if stop < n and (r := ranks.get(token[i : end[stop]])) is not None:
            heappush(heap, (r, i, end[stop]))
        if i and (r := ranks.get(token[before[i] : stop])) is not None:
            heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i : end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """A rank file (base64 token and rank in each line) with its tables."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}
        tokens = sorted(self.ranks, key=self.ranks.get)
        self.id = np.array([self.ranks[t] for t in tokens], np.uint32)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        size = np.array([*map(len, tokens)], np.int64)
        self.size, self.offset = np.zeros(int(self.id.max()) + 1, np.int64), np.zeros(int(self.id.max()) + 1, np.int64)
        self.size[self.id], self.offset[self.id] = size, np.cumsum(size) - size
        keys, checks = self._keys(tokens)
        self.place = PerfectHash(keys)
        order = self.place(keys)
        self.key, self.check, self.of = np.empty_like(keys), np.empty_like(keys), np.empty_like(self.id)
        self.key[order], self.check[order], self.of[order] = keys, checks, self.id
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))

    @staticmethod
    def _keys(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(tokens) + bytes(64), np.uint8)
        ends = np.cumsum([*map(len, tokens)]) if tokens else np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
        return hash_spans(data, starts, ends), hash_spans(data, starts, ends, 7)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; a text is split by the pattern, each match is encoded alone."""
        found = [self.pattern.findall(t.decode()) for t in texts]
        tokens = [t.encode() for t in chain.from_iterable(found)]
        keys, checks = self._keys(tokens)
        place = self.place(keys)
        whole = (self.key[place] == keys) & (self.check[place] == checks) & (place >= 0)
        ids, ranks = self.of[place].tolist(), self.ranks
        for i in np.flatnonzero(~whole).tolist():
            ids[i] = merge(tokens[i], ranks)
        sizes = [len(x) if isinstance(x, list) else 1 for x in ids]
        flat = np.fromiter(chain.from_iterable(x if isinstance(x, list) else (x,) for x in ids), np.uint32, sum(sizes))
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([*map(len, found)])]).astype(np.int64)]
        return flat, np.diff(cuts).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        return gather(self.flat, self.offset[ids], self.size[ids])


def encode_batches(path: str, pattern: str):
    """Add ``ids`` to batches with a text."""

    def run(batches):
        cache = SpanCache(Vocabulary(path, pattern).encode)
        for piece in pieces(batches):
            data, bounds = utf8(piece.column("text"))
            starts, ends, rows = parts(data, bounds, lead=True)
            ids, lengths = cache.ids(data, starts, ends)
            each = np.bincount(rows, lengths, len(bounds) - 1).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each)]), pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], names=["doc_id", "ids"])

    return run


def decode_batches(path: str, pattern: str):
    """Add ``decoded`` to batches with ids."""

    def run(batches):
        vocabulary = Vocabulary(path, pattern)
        for batch in batches:
            lists = batch.column("ids")
            ids, bounds = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            data = vocabulary.decode(ids)
            ends = np.concatenate([[0], np.cumsum(vocabulary.size[ids])])[bounds].astype(np.int32)
            decoded = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, decoded], names=["doc_id", "ids", "decoded"])

    return run


def encode_decode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for, of each document.

    A null text counts as empty and has no ids. Any text is covered, whatever its length; repeated rows give repeated rows, a
    null doc_id stays null, other columns are ignored. The vocabulary's path must exist on every executor.
    """

    def run(batches):
        return decode_batches(path, pattern)(encode_batches(path, pattern)(batches))

    return columns(documents, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
