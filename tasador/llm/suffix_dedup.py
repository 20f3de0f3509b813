"""Removal of long byte strings that occur in an earlier document, with suffix arrays.

1. Anchors. In every window of LENGTH bytes the gram with the smallest hash is its anchor; windows with one anchor make a segment. Equal windows have equal anchors, so
   all that can match meets at the anchor. Only hashes of anchors and segments are exchanged. An anchor met in one document only is done with. Equal segments need no
   comparison: all but those of the smallest document go, and only those of it go on. A window reaches SIDE bytes beyond its anchor on the left or on the right, so segments
   that share a window agree in these bytes on one side; those that agree with no other document's on either side are done with as well.
2. Shards. Segments whose anchor has different segments are sent, as bytes, to the shard of their anchor. Each shard builds the suffix array of its segments by
   induced sorting and the permuted common prefixes; windows that share LENGTH bytes are neighbours in it, and all but those of the smallest document go.
   Segments of an anchor with very many of them are sent window by window, by the hash of the window, so no anchor makes a shard large.
3. The byte ranges of a document are united and cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.scratch import columns, stored
from tasador.llm.suffix_array import Segments, permuted_prefixes, suffix_array
from tasador.llm.text import M1, M2, M3, U64, eights, gather, mix, pieces, utf8

LENGTH = 50
#: Bytes of a gram.
GRAM = 16
#: Bytes that any window has beyond the anchor on one side at least.
SIDE = (LENGTH - GRAM + 1) // 2
#: Segments of one exchange group and bytes of one shard, on average.
A_GROUP, A_SHARD = 1_000_000, 1_500_000
#: Distinct segments from which on an anchor is sent window by window.
MANY = 2048

_ENTRY = np.dtype([("gram", "<u4"), ("gram_high", "<u2"), ("left", "<u2"), ("right", "<u2"), ("segment", "<u8"), ("at", "<u4"), ("more", "u1"), ("owner", "<u2")])
_ASK = np.dtype([("gram", "<u8"), ("at", "<u4"), ("more", "u1"), ("many", "u1")])


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """row, at, more, gram, segment, left, right: segments of windows with one anchor. The windows begin at ``at`` .. ``at + more`` (from the row's first byte);
    gram and segment are hashes of the anchor and of all bytes of the segment with the anchor's place, left and right of the SIDE bytes beside the anchor (0: fewer)."""
    n, reach = int(bounds[-1]), LENGTH - GRAM
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return empty, empty, empty, empty.view(U64), empty.view(U64), empty, empty
    words = eights(data)
    gram = mix(words[:n] * M1 ^ words[8 : n + 8] * M2 + M3)
    least, place, width = gram, np.arange(n, dtype=np.int32), 1
    while width < reach + 1:
        step = min(width, reach + 1 - width)
        right = least[step:] < least[:-step]
        place, least = np.where(right, place[step:], place[:-step]), np.minimum(least[step:], least[:-step])
        width += step
    valid = np.zeros(n, bool)
    sizes = np.diff(bounds)
    long = np.flatnonzero(sizes >= LENGTH)
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, bounds[long], 1)
    np.add.at(step, bounds[long] + sizes[long] - LENGTH + 1, -1)
    valid = np.cumsum(step[:n])[: len(place)] > 0
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | ~valid[:-1]
    change[bounds[long]] = True
    begin = np.flatnonzero(change & valid)
    stop = np.ones(len(place), bool)
    stop[:-1] = change[1:] | ~valid[1:]
    end = np.flatnonzero(stop & valid)
    whole = np.zeros(len(begin), U64)
    for at in (begin, end):
        for k in (0, 8, 16, 24, 32, 40, LENGTH - 8):
            whole = mix(whole + words[at + k])
    anchor = place[begin]
    whole = mix(whole + (end - begin).astype(U64) * M1 + (anchor - begin).astype(U64) * M3)
    row = np.searchsorted(bounds, begin, "right") - 1
    sides = []
    for first, there in ((anchor - SIDE, anchor - SIDE >= bounds[row]), (anchor + GRAM, anchor + GRAM + SIDE <= bounds[row + 1])):
        first = np.where(there, first, 0)
        side = mix(words[first] * M1 ^ mix(words[first + 8] + M2) ^ words[first + SIDE - 8] * M3)
        sides.append(np.where(there, (side >> U64(48)) | U64(1), U64(0)))
    return row, begin - bounds[row], end - begin, gram[anchor], whole, *sides


def _binary(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The items of ``flat`` between each two ``cuts``, as bytes."""
    offsets = (cuts * flat.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _read(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All items of a column of bytes, and how many each row has."""
    parts, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for c in column.chunks:
        bounds = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset : c.offset + len(c) + 1]
        if len(bounds) and bounds[-1] > bounds[0]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[bounds[0] : bounds[-1]])
        sizes.append(np.diff(bounds).astype(np.int64))
    items = np.concatenate(parts).view(kind)
    return items, np.concatenate(sizes) // items.dtype.itemsize


def _packs(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows sorted by key, then row: where each key begins (and the end), the place of each row among the distinct rows of its key, these rows, and where those of each key begin (and the end).
    There are about as many keys as pieces of text, so nothing here takes time for each key."""
    first = np.flatnonzero(np.diff(key, prepend=-1))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])
    number = np.cumsum(new) - 1
    cuts = np.append(first, len(key))
    return cuts, number - np.repeat(number[first], np.diff(cuts)), row[new], np.append(number[first], number[-1] + 1)


def _exchange(groups: int):
    """Packs of anchors and segments for each group."""

    def run(batches):
        for piece in pieces(batches, 1 << 20):
            for at in range(0, piece.num_rows, 60_000):
                part = piece.slice(at, 60_000)
                row, begin, more, gram, segment, left, right = segments(*utf8(part.column("text")))
                if not len(row):
                    continue
                group = (gram % U64(groups)).astype(np.int64)
                order = np.argsort(group.astype(np.uint16) if groups < 65536 else group, kind="stable")
                group = group[order]
                cuts, owner, used, own = _packs(group, row[order])
                entries = np.empty(len(row), _ENTRY)
                entries["gram"], entries["gram_high"], entries["left"], entries["right"] = gram & U64(2**32 - 1), gram >> U64(48), left, right
                entries["segment"], entries["at"], entries["more"] = segment, begin, more
                entries = entries[order]
                entries["owner"] = owner
                ids, keys = part.column("doc_id").to_numpy(), part.column("key").to_numpy()
                arrays = [pa.array(group[cuts[:-1]], pa.int32()), _binary(entries, cuts), _binary(ids[used], own), _binary(keys[used], own)]
                yield pa.RecordBatch.from_arrays(arrays, names=["group", "entries", "ids", "keys"])

    return run


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal ranges that the given ones cover; touching ranges are one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, far = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], start[1:] > far[:-1]])
    return start[first], far[np.append(np.flatnonzero(first)[1:] - 1, len(far) - 1)]


def _ranges(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The owners, and the united ranges of each."""
    own = owner.astype(np.int64) << 33  # beyond any end, so ranges of two owners do not touch
    start, end = united(start.astype(np.int64) + own, end.astype(np.int64) + own)
    owner = start >> 33
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[begin], _binary((np.stack([start, end], 1) - (owner << 33)[:, None]).astype("<u4").ravel(), 2 * np.append(begin, len(owner)))


_FOUND = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("ranges", pa.binary()), ("asks", pa.binary()), ("bytes", pa.int64())])


def _beside(group: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have the bytes of one side in common with an entry of their group and another document."""
    order = np.lexsort((side, group))
    g, s, d = group[order], side[order], doc[order]
    out = np.zeros(len(order), bool)
    if len(order):
        begin = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])]))
        several = np.minimum.reduceat(d, begin) != np.maximum.reduceat(d, begin)
        out[order] = np.repeat(several, np.diff(np.append(begin, len(order)))) & (s > 0)
    return out


def _meet(many: int):
    """Rows of documents: ranges to remove, or segments to compare."""

    def run(packs: pa.Table) -> pa.Table:
        (ids, docs), (keys, _), (entries, parts) = (_read(packs.column(name), kind) for name, kind in (("ids", np.int64), ("keys", np.int64), ("entries", _ENTRY)))
        owner = entries["owner"] + np.repeat(np.cumsum(docs) - docs, parts)
        del packs
        gram = entries["gram"].astype(np.uint64) | entries["gram_high"].astype(np.uint64) << U64(32)
        order = np.argsort(gram)
        repeated = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
        order = order[np.unique(np.concatenate([repeated, repeated + 1]))]
        entries, owner, gram = entries[order], owner[order], gram[order]
        doc, segment = ids[owner], entries["segment"]
        order = np.lexsort((doc, segment, gram))
        entries, owner, doc, gram, segment = entries[order], owner[order], doc[order], gram[order], segment[order]
        new = np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)]
        distinct = np.concatenate([[True], (segment[1:] != segment[:-1]) | new[1:]])[: len(gram)]
        at = np.flatnonzero(distinct)
        size = np.diff(np.append(at, len(gram)))
        lowest = np.repeat(doc[at], size)
        remove = doc > lowest
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        kinds = np.add.reduceat(distinct, begin) if len(begin) else begin
        differ = (np.minimum.reduceat(lowest, begin) != np.maximum.reduceat(lowest, begin)) if len(begin) else begin
        compare = ~remove & ((kinds > 1) & differ)[group] if len(begin) else remove
        compare[compare] = _beside(group[compare], entries["left"][compare], doc[compare]) | _beside(group[compare], entries["right"][compare], doc[compare])
        start = entries["at"].astype(np.int64)
        gone, ranges = _ranges(owner[remove], start[remove], (start + entries["more"] + LENGTH)[remove])
        asks = np.empty(int(compare.sum()), _ASK)
        asks["gram"], asks["at"], asks["more"] = gram[compare], entries["at"][compare], entries["more"][compare]
        asks["many"] = (kinds > many)[group[compare]] if len(begin) else 0
        order = np.argsort(owner[compare], kind="stable")
        asks, asking = asks[order], owner[compare][order]
        first = np.flatnonzero(np.diff(asking, prepend=-1))
        weight = np.where(asks["many"] > 0, (asks["more"].astype(np.int64) + 1) * LENGTH, asks["more"].astype(np.int64) + LENGTH)
        who = np.concatenate([gone, asking[first]])
        weight = np.concatenate([np.zeros(len(gone), np.int64), np.add.reduceat(weight, first) if len(first) else first])
        lists = [pa.concat_arrays([ranges, pa.nulls(len(first), pa.binary())]), pa.concat_arrays([pa.nulls(len(gone), pa.binary()), _binary(asks, np.append(first, len(asks)))])]
        return pa.table([pa.array(ids[who]), pa.array(keys[who]), *lists, pa.array(weight)], schema=_FOUND)

    return run


def _send(shards: int):
    """Bytes of the segments to compare, in packs for each shard."""

    def run(batches):
        for piece in pieces(batches, 1 << 20):
            data, bounds = utf8(piece.column("text"))
            asked = [np.concatenate([np.frombuffer(x, _ASK) for x in lists]) for lists in piece.column("asks").to_pylist()]
            row = np.repeat(np.arange(len(asked)), [*map(len, asked)])
            asks = np.concatenate(asked)
            at, more, gram = asks["at"].astype(np.int64), asks["more"].astype(np.int64), asks["gram"].copy()
            single = asks["many"] > 0
            each = np.where(single, more + 1, 1)
            shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            row, at, gram, single = np.repeat(row, each), np.repeat(at, each) + shift, np.repeat(gram, each), np.repeat(single, each)
            length = np.where(single, 0, np.repeat(more, each)) + LENGTH
            if single.any():
                words, one = eights(data), bounds[row[single]] + at[single]
                whole = gram[single]
                for k in (0, 8, 16, 24, 32, 40, LENGTH - 8):
                    whole = mix(whole + words[one + k])
                gram[single] = whole
            shard = (mix(gram) % U64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            row, at, length, shard = row[order], at[order], length[order], shard[order]
            cuts, place, used, own = _packs(shard, row)
            first = bounds[row] + at
            flat = np.concatenate([gather(data, first[k : k + 16384], length[k : k + 16384]) for k in range(0, len(row), 16384)])  # single windows are many times their text
            ids, keys = piece.column("doc_id").to_numpy(), piece.column("key").to_numpy()
            arrays = [pa.array(shard[cuts[:-1]], pa.int32()), _binary(flat, np.concatenate([[0], np.cumsum(length)])[cuts]), *(_binary(x.astype("<u4"), cuts) for x in (length, at, place)), _binary(ids[used], own), _binary(keys[used], own)]
            yield pa.RecordBatch.from_arrays(arrays, names=["shard", "flat", "lengths", "starts", "owners", "ids", "keys"])

    return run


def _shard(packs: pa.Table) -> pa.Table:
    """Ranges to remove, from the suffix array of a shard's segments."""
    (flat, _), (lengths, _), (starts, _), (owners, parts), (ids, docs), (keys, _) = (
        _read(packs.column(name), kind) for name, kind in (("flat", np.uint8), ("lengths", "<u4"), ("starts", "<u4"), ("owners", "<u4"), ("ids", np.int64), ("keys", np.int64))
    )
    del packs
    lengths, starts, owners = lengths.astype(np.int64), starts.astype(np.int64), owners + np.repeat(np.cumsum(docs) - docs, parts)
    s = Segments(flat, lengths)
    array = suffix_array(s)
    step = np.zeros(len(s.byte) + 1, np.int8)
    step[s.start] += 1
    step[s.start + lengths - LENGTH + 1] -= 1
    full = np.cumsum(step[:-1]) > 0  # places where a window begins that ends in the segment
    array = array[full[array]]
    prefix = permuted_prefixes(s, array, LENGTH)
    segment = np.searchsorted(s.start, array, "right") - 1
    doc = ids[owners[segment]]
    new = prefix[array] < LENGTH
    begin = np.flatnonzero(new)
    lowest = np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(array))))
    gone = doc > lowest
    segment = segment[gone]
    at = array[gone] - s.start[segment] + starts[segment]
    who, ranges = _ranges(owners[segment], at, at + LENGTH)
    return pa.table({"doc_id": pa.array(ids[who]), "key": pa.array(keys[who]), "ranges": ranges})


def _cut(batches):
    """Unite the ranges of each document and cut them out."""
    for piece in pieces(batches):
        data, bounds = utf8(piece.column("text"))
        starts, ends, kept = [], [], []
        for lists, a, b in zip(piece.column("ranges").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            r = np.concatenate([np.frombuffer(x, "<u4").reshape(-1, 2) for x in lists]).astype(np.int64) if lists else np.zeros((0, 2), np.int64)
            start, end = united(r[:, 0], r[:, 1])
            starts.append(start)
            ends.append(end)
            edges = [0, *np.stack([start, end], 1).ravel().tolist(), b - a]
            kept.append(b"".join(data[a + x : a + y].tobytes() for x, y in zip(edges[::2], edges[1::2])))
        kinds = pa.list_(pa.int64())
        arrays = [piece.column("doc_id"), piece.column("key"), pa.array(np.diff(bounds)), pa.array(starts, kinds), pa.array(ends, kinds), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n_bytes", "starts", "ends", "kept"])


def repeated_ranges(docs: DataFrame, many: int = MANY) -> DataFrame:
    """doc_id, key, ranges (list of packed start and end pairs) of the documents (doc_id, text, key) that repeat bytes of a smaller doc_id."""
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(16, int(size * 2 / (LENGTH - GRAM + 2)) // A_GROUP)
    packs = known.mapInArrow(_exchange(groups), "group int, entries binary, ids binary, keys binary")
    met = stored(packs.groupBy("group").applyInArrow(_meet(many), "doc_id long, key long, ranges binary, asks binary, bytes long"), "met")
    asks = met.where("asks IS NOT NULL").groupBy("doc_id", "key").agg(F.collect_list("asks").alias("asks"))
    shards = max(16, int(met.agg(F.sum("bytes")).first()[0] or 0) // A_SHARD)
    sent = known.join(asks, ["doc_id", "key"]).mapInArrow(_send(shards), "shard int, flat binary, lengths binary, starts binary, owners binary, ids binary, keys binary")
    more = stored(sent.groupBy("shard").applyInArrow(_shard, "doc_id long, key long, ranges binary"), "shards")
    ranges = met.where("ranges IS NOT NULL").select("doc_id", "key", "ranges").union(more)
    return ranges.groupBy("doc_id", "key").agg(F.collect_list("ranges").alias("ranges"))


def remove_repeats(documents: DataFrame, many: int = MANY) -> DataFrame:
    """doc_id, key, n_bytes, starts, ends, kept: each document without the bytes covered by a string of LENGTH bytes that also starts in a smaller doc_id.

    Texts are UTF-8 bytes; a null text is empty. Matches are judged on the input, overlaps count, and starts and ends are the maximal removed runs. Rows with the
    same doc_id do not shorten one another; equal rows are treated alike. A row without doc_id is kept whole and removes nothing. key is a hash of the text that
    tells rows of one doc_id apart. Texts under LENGTH bytes are kept whole. Other columns are ignored.
    """
    docs = columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    ranges = repeated_ranges(docs, many)
    joined = docs.join(ranges, ["doc_id", "key"], "left").select("doc_id", "key", "text", "ranges")
    return joined.mapInArrow(_cut, "doc_id long, key long, n_bytes long, starts array<long>, ends array<long>, kept binary")


def repeat_summary(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = remove_repeats(documents)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _decode(batches):
    for batch in batches:
        kept = [x.decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(kept, pa.string())], names=["doc_id", "key", "kept_text"])


def shortened_texts(documents: DataFrame) -> DataFrame:
    """doc_id, key, kept_text of the documents that lose bytes; characters of which only a part is left go too."""
    rows = remove_repeats(documents).where(F.size("starts") > 0).select("doc_id", "key", "kept")
    return rows.mapInArrow(_decode, "doc_id long, key long, kept_text string").dropDuplicates(["doc_id", "key"])
