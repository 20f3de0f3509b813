"""Bytes, words and hashes of a batch of texts, for all rows at once.

A text column arrives as one buffer of UTF-8 bytes with row bounds. Nothing here loops over words: words
are ranges in the buffer and their hashes are computed eight bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multipliers with well spread bits.
M1, M2, M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Bytes of text handled at once; bounds the memory of a Python worker.
PIECE = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space of the shingle words: space and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
#: All but digits, ASCII letters and bytes outside ASCII.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers; a bijection."""
    x = (x ^ (x >> U64(30))) * M2
    x = (x ^ (x >> U64(27))) * M3
    return x ^ (x >> U64(31))


def pieces(batches, size: int = PIECE, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at, done = 0, 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at, done = to, ends[to - 1]
        pa.default_memory_pool().release_unused()


def utf8(column: pa.Array, pad: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, followed by ``pad`` zeros, and where rows begin (one bound more than rows). Null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first, last = int(bounds[0]), int(bounds[-1])
    data = np.zeros(last - first + pad, np.uint8)
    if last > first:
        data[: last - first] = np.frombuffer(column.buffers()[2], np.uint8)[first:last]
    return data, bounds - first


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; eight places fewer than bytes."""
    return np.ndarray((len(data) - 8,), "<u8", data, strides=(1,))


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that stay within a row: starts, ends, rows. ``inside`` has one entry per byte."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    firsts = bounds[:-1][bounds[:-1] < n]
    begin[firsts] = inside[firsts]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    last[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U64)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range; ``data`` must be padded as by :func:`utf8`."""
    words, size = eights(data), ends - starts
    out = mix(words[starts] & _KEEP[np.minimum(size, 8)] ^ U64(seed)) + size.astype(U64) * M1
    active, at = np.flatnonzero(size > 8), 8
    while len(active):
        block = words[starts[active] + at] & _KEEP[np.minimum(size[active] - at, 8)]
        out[active] = mix(out[active] * M1 ^ block) + U64(at)
        at += 8
        active = active[size[active] > at]
    return mix(out)


def gather(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate the ranges ``flat[offsets[i] : offsets[i] + lengths[i]]`` in order."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    shift = np.repeat(offsets - (ends - lengths), lengths)
    shift += np.arange(total)
    return flat[shift]
