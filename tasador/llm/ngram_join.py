"""Similarity join on word shingles with parity sketches.

A document's set holds its distinct five-word shingles as 64-bit hashes. Sets of similar size fall into the same or
neighbouring size bands (band j: 2**j <= size < 2**(j+1)). In a band, tokens are dealt into 2**(j+1) cells by hash, and a cell
holds the XOR of its tokens: a sketch over GF(2). A token in only one of two sets changes one cell, so the number of differing cells
is at most the symmetric difference. Linked sets of sizes a and b differ in at most (a + b) / 7 tokens
(for 0.75), so they agree in all but so many cells, and pigeonholing means that the first D + 1 filled cells of either, in any common order,
hold an equal cell. The common order puts cells made only of frequent tokens last, so a passage that many documents share does not
bring them together. Equal cells give candidate pairs; a bit sketch (one parity bit per token) whose Hamming distance is a lower bound
of the symmetric difference drops most of the wrong ones; the sets themselves decide.

Equal sets are one class and meet once. Cells with more than ``SMALL`` classes send no pairs. The smallest class of such a cell leads it, and the classes of all cells with one leader are a crowd: classes
that share a cell meet in the crowd of its leader, and cells that merely touch stay apart, as chains of them run through much of a large corpus. A crowd is compared in square blocks of bounded size, each in
one task: once by sketches alone, which leave the classes that may link to another of the crowd, then these by sketches and sets, and only the links of a spanning forest leave the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.components import components
from tasador.llm.scratch import bit_table, columns, stored
from tasador.llm.text import BLANK, LOWER, M1, M2, M3, U64, hash_spans, mix, pieces, spans, utf8

WIDTH = 5
#: A pair links when PART * |intersection| >= share * |union|, as whole numbers out of 100.
SHARE = 75
#: Cells shared by more classes are compared in blocks; classes of a crowd, and bytes of what is compared of them, on one side of a block.
SMALL = 24
BLOCK, BLOCK_BYTES = 4096, 16 << 20
#: Cells of one group in the exchange, on average.
CELLS_A_GROUP = 2_000_000
#: Bytes of a cell and of a set's fingerprint in the exchange. Cells that agree only in these are candidates too many, dropped on the sets.
CELL, NODE = 6, 16
#: A token is frequent if it was counted so often, where only counts of LOCAL and more within a batch of rows are added up. Frequent tokens are kept as a table of
#: FLAGS bits, of one size for any input; tokens that share a bit with one count as frequent too. All this changes the order of cells, never the result.
OFTEN, LOCAL, FLAGS = 12, 3, 1 << 25
_FACTORS = np.array([M1, M2, M3, M1, M2], U64) * np.array([1, 1, 1, 3, 5], U64)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words has one shingle, a row without words none."""
    starts, ends, rows = spans(~BLANK[data[: bounds[-1]]], bounds)
    factors = np.resize(_FACTORS, width) + U64(2) * np.arange(width, dtype=U64)
    words = hash_spans(LOWER[data], starts, ends)
    first = np.searchsorted(rows, np.arange(len(bounds)))
    total = np.zeros(max(len(words) - width + 1, 0), U64)
    for k in range(width):
        total += words[k : k + len(total)] * factors[k]
    total = mix(total)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(np.unique(total[a : b - width + 1]))
        elif b > a:
            out.append(mix(np.array([np.bitwise_xor.reduce(mix(words[a:b] * factors[: b - a] + np.arange(b - a, dtype=U64))) + U64(b - a)], U64)))
        else:
            out.append(words[:0])
    return out


def fingerprint(tokens: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([mix(tokens ^ M3).sum(dtype=U64), np.bitwise_xor.reduce(mix(tokens + M1)) + U64(len(tokens))], U64).tobytes()


def band(n: int) -> int:
    return n.bit_length() - 1


def bit_sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens by the low bits of their hash; four bits for each token a set of the band may have."""
    bits = max(256, 4 << band(len(tokens)))
    return np.packbits(np.bincount((tokens & U64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of fewer bits: those that share low address bits are added. Works on the last axis."""
    while sketch.shape[-1] > size:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def most_apart(a, b, share: int = SHARE):
    """The largest symmetric difference of linked sets of these sizes: (a + b) * (100 - share) / (100 + share), rounded down."""
    return (a + b) * (100 - share) // (100 + share)


def cells(tokens: np.ndarray, frequent: np.ndarray, share: int = SHARE) -> np.ndarray:
    """The cells under which a set is posted, for its own band and the next one that a linked larger set may be in."""
    n, out = len(tokens), []
    largest = n * 100 // share
    place = (tokens & U64(FLAGS - 1)).astype(np.int64)
    rare = (frequent[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 0
    for j in range(band(n), band(largest) + 1):
        partner = min(largest, (2 << j) - 1)
        if j < 7:  # small sets: a cell for each token
            cell, xor, hot = None, tokens, ~rare
        else:
            cell = (tokens >> U64(63 - j)).astype(np.int64)  # tokens are sorted, so cells are
            begin = np.flatnonzero(np.diff(cell, prepend=-1))
            xor, hot = np.bitwise_xor.reduceat(tokens, begin), ~np.logical_or.reduceat(rare, begin)
            keep = xor != 0
            xor, hot = xor[keep], hot[keep]
        key = mix(xor * M2 + U64(j))
        key = key[np.lexsort((key, hot))] if hot.any() else np.sort(key)
        out.append(key[: most_apart(n, partner, share) + 1])
    return np.concatenate(out)


_SETS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("sketch", pa.binary()), ("token", pa.int64())])


def _describe(batches):
    """A row of each document, and rows (n: documents, token) of tokens that many documents of a batch have."""
    for batch in batches:
        seen = [np.zeros(0, U64)]
        for piece in pieces([batch]):
            sets = shingle_sets(*utf8(piece.column("text")))
            seen += sets
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id").cast(pa.int64()), piece.column("key"), pa.array([*map(len, sets)], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([bit_sketch(s) if len(s) else None for s in sets], pa.binary()), none,
            ], schema=_SETS)
        token = np.sort(np.concatenate(seen))
        del seen
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, len(token)))
        token, count = token[begin[count >= LOCAL]], count[count >= LOCAL]
        for at in range(0, len(token), 100_000):
            some = token[at : at + 100_000]
            none = pa.nulls(len(some), pa.int64())
            binary = pa.nulls(len(some), pa.binary())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(count[at : at + 100_000], pa.int64()), binary, binary, pa.array(some.view(np.int64))], schema=_SETS)


_PACK = "group int, cells binary, nodes binary, counts binary"


def _post(frequent: np.ndarray, groups: int, share: int):
    """Deal the cells of each piece of text into groups: one pack of sets and their cells for each group."""

    def run(batches):
        for piece in pieces(batches):
            known = {}
            for s in shingle_sets(*utf8(piece.column("text"))):
                if len(s):
                    known.setdefault(fingerprint(s), s)
            if not known:
                continue
            posted = [cells(s, frequent, share) for s in known.values()]
            cell, owner = np.concatenate(posted), np.repeat(np.arange(len(posted)), [*map(len, posted)])
            del posted
            group = (cell % U64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            cell, owner = cell[order].view(np.uint8).reshape(-1, 8)[:, 8 - CELL :], owner[order]
            cuts = np.searchsorted(group[order], np.arange(groups + 1))
            nodes, rows = np.frombuffer(b"".join(known), f"V{NODE}"), []
            for g in np.flatnonzero(np.diff(cuts)):
                used, counts = np.unique(owner[cuts[g] : cuts[g + 1]], return_counts=True)
                rows.append((int(g), cell[cuts[g] : cuts[g + 1]].tobytes(), nodes[used].tobytes(), counts.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))], names=["group", "cells", "nodes", "counts"])

    return run


_MET = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("cell", pa.int64())])


def _meet(packs: pa.Table) -> pa.Table:
    """Pairs (a, b) of sets that share a cell; of large cells rows (a, null, cell) of all sets."""
    read = lambda name, kind: np.frombuffer(b"".join(packs.column(name).to_pylist()), kind)
    halves, counts, raw = read("nodes", np.uint64).reshape(-1, 2), read("counts", np.uint32), read("cells", np.uint8).reshape(-1, CELL)
    del packs
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(1)
    name = np.empty(len(order), np.int64)
    name[order] = np.cumsum(new) - 1
    nodes, who = halves[order[new]], np.repeat(name, counts)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - CELL :] = raw
    cell = wide.view(np.uint64)[:, 0]
    del raw, wide
    order = np.argsort(cell)
    repeated = np.flatnonzero(cell[order[1:]] == cell[order[:-1]])
    order = order[np.unique(np.concatenate([repeated, repeated + 1]))]  # only cells that occur twice
    order = order[np.lexsort((who[order], cell[order]))]
    cell, who = cell[order], who[order]
    once = np.ones(len(cell), bool)
    once[1:] = (cell[1:] != cell[:-1]) | (who[1:] != who[:-1])
    cell, who = cell[once], who[once]
    begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(cell)))
    large = np.repeat(size > SMALL, size)
    left, right = [who[:0]], [who[:0]]
    x, c = who[~large], cell[~large]
    for k in range(1, SMALL):
        same = np.flatnonzero(c[k:] == c[: len(c) - k]) if len(c) > k else np.zeros(0, np.int64)
        if not len(same):
            break
        left.append(x[same])
        right.append(x[same + k])
    pair = np.unique(np.concatenate(left) * len(nodes) + np.concatenate(right))
    a, b = np.divmod(pair, max(len(nodes), 1))
    key = lambda i: pa.array([nodes[k].tobytes() for k in i], pa.binary())
    a, b, member = a[a != b], b[a != b], who[large]
    return pa.table({"a": pa.concat_arrays([key(a), key(member)]), "b": pa.concat_arrays([key(b), pa.nulls(len(member), pa.binary())]), "cell": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(cell[large].view(np.int64))])}, schema=_MET)


def _thin(batches, rows: int = 512):
    """Slices of few rows, as rows are wide."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _near(share: int):
    """Keep pairs whose bit sketches do not rule a link out."""

    def run(batches):
        for batch in _thin(batches):
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            most = most_apart(na, nb, share)
            keep = []
            for x, y, m in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), most):
                p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                bits = min(len(p), len(q))
                keep.append(int(np.bitwise_count(fold(p, bits) ^ fold(q, bits)).sum()) <= m)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b", "ra", "rb"])

    return run


def _sets_of(batches):
    for piece in pieces(batches):
        sets = shingle_sets(*utf8(piece.column("text")))
        batch = pa.RecordBatch.from_arrays([piece.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "tokens"])
        # another row of the same doc_id may have another text
        yield batch.filter(pa.array([len(s) > 0 and fingerprint(s) == n for s, n in zip(sets, piece.column("node").to_pylist())], pa.bool_()))


def _linked(share: int):
    """Keep pairs whose sets link, decided on the sets."""

    def run(batches):
        for batch in _thin(batches):
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                p, q = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = np.sort(np.concatenate([p, q]))
                inter = int((both[1:] == both[:-1]).sum())
                keep.append(100 * inter >= share * (len(p) + len(q) - inter))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["ra", "rb"])

    return run


def _flagged(table: np.ndarray):
    """Rows whose place is set in the table."""

    def run(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            keep = (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(keep.astype(bool))).select(["doc_id", "text"])

    return run


def _tokens(wanted: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """node, tokens of the wanted classes (node, rep), from the text of the representative."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FLAGS)).cast("int").alias("place")
    table = bit_table(wanted.select(place("rep")), FLAGS)
    few = docs.select("doc_id", "text", place("doc_id")).mapInArrow(_flagged(table), "doc_id long, text string")  # only these are shuffled
    sets = few.join(wanted, few.doc_id == wanted.rep).select("node", "text").mapInArrow(_sets_of, "node binary, tokens binary")
    return stored(sets.dropDuplicates(["node"]), name)


def _decide(pairs: DataFrame, classes: DataFrame, docs: DataFrame, share: int) -> DataFrame:
    """Links (u, v) between class representatives, of the candidate pairs (a, b)."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("rep").alias(f"r{x}"), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    fit = 100 * F.least("na", "nb") >= share * F.greatest("na", "nb")
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(fit).mapInArrow(_near(share), "a binary, b binary, ra long, rb long")
    near = stored(near, "near")
    sets = _tokens(near.select(F.col("a").alias("node"), F.col("ra").alias("rep")).union(near.select("b", "rb")).distinct(), docs, "near_sets")
    pick = lambda x: sets.select(F.col("node").alias(x), F.col("tokens").alias(f"t{x}"))
    links = near.join(pick("a"), "a").join(pick("b"), "b").select("ra", "rb", "ta", "tb").mapInArrow(_linked(share), "ra long, rb long")
    return stored(links.select(F.col("ra").alias("u"), F.col("rb").alias("v")), "links")


def _by_length(sketches: list[np.ndarray]) -> dict[int, np.ndarray]:
    """All sketches by each length that one of them has; those of longer ones folded to it."""
    return {k: np.stack([fold(s, k) if len(s) >= k else np.zeros(k, np.uint8) for s in sketches]).view(np.uint64) for k in {*map(len, sketches)}}


def _beside(share: int):
    """Classes of two blocks of one crowd whose sketches do not rule out a link to another one."""

    def run(rows: pa.Table) -> pa.Table:
        part, n = rows.column("part").to_numpy(), rows.column("n").to_numpy()
        sketches = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
        one = bool((rows.column("i").to_numpy() == rows.column("j").to_numpy())[0])
        bits, found = _by_length(sketches), np.zeros(len(n), bool)
        order = np.argsort(n, kind="stable")
        last = np.searchsorted(n[order], n[order] * 100 // share, "right")
        for k, i in enumerate(order.tolist()):
            # partners are as large or larger, up to where the sizes alone rule a link out
            other = order[k + 1 : last[k]]
            other = other[(one | (part[other] != part[i])) & ~(found[other] & found[i])]
            if len(other):
                mine = bits[len(sketches[i])]
                near = np.bitwise_count(mine[other] ^ mine[i]).sum(1) <= most_apart(n[other], n[i], share)
                found[other[near]] = True
                found[i] |= near.any()
        return rows.select(["crowd", "node"]).filter(pa.array(found))

    return run


def _compare(share: int):
    """A spanning forest of the links between two blocks of one crowd, decided on the sets."""

    def run(rows: pa.Table) -> pa.Table:
        part, n, rep = rows.column("part").to_numpy(), rows.column("n").to_numpy(), rows.column("rep").to_numpy()
        sketches = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
        tokens = [np.frombuffer(x, U64) for x in rows.column("tokens").to_pylist()]
        one = bool((rows.column("i").to_numpy() == rows.column("j").to_numpy())[0])
        del rows
        bits = _by_length(sketches)
        part = np.zeros(len(n), np.int64) if one else part
        component, out = np.arange(len(n)), []
        order = np.argsort(n, kind="stable")
        for k, i in enumerate(order.tolist()):
            # partners are as large or larger, up to where the sizes alone rule a link out
            other = order[k + 1 : np.searchsorted(n[order], n[i] * 100 // share, "right")]
            other = other[(component[other] != component[i]) & (one | (part[other] != part[i]))]
            if not len(other):
                continue
            mine = bits[len(sketches[i])]
            near = np.bitwise_count(mine[other] ^ mine[i]).sum(1) <= most_apart(n[other], n[i], share)
            for j in other[near].tolist():
                if component[i] != component[j]:
                    both = np.sort(np.concatenate([tokens[i], tokens[j]]))
                    inter = int((both[1:] == both[:-1]).sum())
                    if 100 * inter >= share * (len(both) - inter):
                        component[component == component[j]] = component[i]
                        out.append((i, j))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"u": pa.array(rep[pairs[:, 0]]), "v": pa.array(rep[pairs[:, 1]])})

    return run


def led(crowd: DataFrame) -> DataFrame:
    """crowd, node: the classes of each crowd, from those (cell, node) of large cells. The leader, and so the crowd, of a cell is its smallest class by hash."""
    crowd = stored(crowd.select("cell", "node", F.xxhash64("node").alias("v")), "crowd")
    lead = crowd.groupBy("cell").agg(F.min("v").alias("crowd"))
    return crowd.join(lead, "cell").select("crowd", "node").distinct()


def _dealt(nodes: DataFrame, held, *more: str) -> DataFrame:
    """The classes of each crowd dealt to pairs (i, j) of its blocks. ``held``: bytes of a class."""
    sizes = nodes.groupBy("crowd").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(held) / BLOCK_BYTES)).cast("int").alias("blocks"))
    return (
        nodes.join(sizes, "crowd")
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("crowd", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("part"), "n", "sketch", *more)
    )


def _crowds(crowd: DataFrame, classes: DataFrame, docs: DataFrame, share: int) -> DataFrame:
    """Links (u, v) of the classes (cell, node) of large cells."""
    nodes = stored(led(crowd).join(classes, "node").select("crowd", "node", "n", "rep", "sketch"), "crowds")
    beside = _dealt(nodes, F.octet_length("sketch"), "node").groupBy("crowd", "i", "j").applyInArrow(_beside(share), "crowd long, node binary")
    nodes = stored(nodes.join(beside.distinct(), ["crowd", "node"], "left_semi"), "beside")
    sets = _tokens(nodes.select("node", "rep").distinct(), docs, "crowd_sets")
    dealt = _dealt(nodes, 8 * F.col("n") + F.octet_length("sketch"), "rep", "node").join(sets, "node")
    return stored(dealt.groupBy("crowd", "i", "j").applyInArrow(_compare(share), "u long, v long"), "crowd_links")


def similarity_join(documents: DataFrame, share: int = SHARE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Membership, links and components of the documents.

    Returns ``members`` (doc_id, key: a hash of the text, n_shingles, class_id), ``links`` (u, v) between class representatives (class_id: the smallest doc_id with
    exactly that set), enough of them to connect every pair that links, and ``parts`` (node, component) of the linked classes.
    Null and blank texts have an empty set and are their own class. Repeated rows are members of one class. A null doc_id takes
    no part in links: its class is null. Other columns are ignored. Sets are compared by 64-bit token hashes.
    """
    docs = columns(documents, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    seen = stored(docs.mapInArrow(_describe, "doc_id long, key long, n long, node binary, sketch binary, token long"), "sets")
    rows = seen.where("token IS NULL")
    total = rows.agg(F.sum("n")).first()[0]
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("node", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
    classes = stored(classes, "classes")
    often = seen.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)
    frequent = bit_table(often.select(F.col("token").bitwiseAND(FLAGS - 1).alias("place")), FLAGS)
    groups = max(16, int((total or 0) * 0.5) // CELLS_A_GROUP)
    packs = docs.where("doc_id IS NOT NULL").mapInArrow(_post(frequent, groups, share), _PACK)
    met = stored(packs.groupBy("group").applyInArrow(_meet, "a binary, b binary, cell long"), "met")
    pairs = met.where("b IS NOT NULL").select("a", "b").distinct()
    links = _decide(pairs, classes, docs, share)
    crowd = met.where("b IS NULL").select("cell", F.col("a").alias("node"))
    if not crowd.isEmpty():
        links = links.union(_crowds(crowd, classes, docs, share))
    parts = components(links)
    members = rows.join(classes.select("node", "rep"), "node", "left").select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"))
    members = members.withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")))
    return members, links, parts


def near_duplicates(documents: DataFrame, share: int = SHARE) -> DataFrame:
    """A row per document: doc_id, key, n_shingles, component_id (the smallest doc_id that links reach, its own included)."""
    members, _, parts = similarity_join(documents, share)
    found = members.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left")
    return found.select("doc_id", "key", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))
