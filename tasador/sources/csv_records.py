"""Records of CSV files whose quoted texts may hold line breaks, from files that are split over many tasks.

Lines are read once, by any number of tasks. A task cannot know whether its block begins inside a quoted text. It takes it that it does not, puts records together and stores them, and notes for
both cases in which state the block ends and how many records it begins. Following these notes through the blocks of a file tells where the guess was wrong; only such blocks are split into
their lines and put together anew, and only what lies across the bounds of blocks is brought together by a shuffle.
"""

from __future__ import annotations

import csv
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasador.operators.lookup import small_enough
from tasador.session import durable

# tasks of any cluster get the functions of this module with their work
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names of the columns that keep where a record was read, the size of its file, and its number over all files (from 0, in the order of files).
FILE, BLOCK, BYTES, POSITION = "_file", "_block", "_bytes", "_position"
BYTE_ORDER_MARK = "\ufeff"
#: Blocks whose starts are broadcast at most; some 20 bytes each.
BLOCKS = 2_000_000


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside a quoted text, if its beginning does or does not. A quote that does not open a field is an ordinary character; two are one inside."""
    at = 0
    while True:
        if not inside:
            if line[at : at + 1] == '"':
                inside, at = True, at + 1
            else:
                at = line.find(",", at) + 1
                if not at:
                    return False
                continue
        while True:
            at = line.find('"', at) + 1
            if not at:
                return True
            if line[at : at + 1] != '"':
                break
            at += 1
        inside = False
        at = line.find(",", at) + 1
        if not at:
            return False


def _states(lines: pa.Array, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State before and after each line, and whether it begins a record, for a given state before the first."""
    n = len(lines)
    before, after, now, at = np.zeros(n, bool), np.zeros(n, bool), inside, 0
    for i in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist():
        before[at : i + 1], after[at:i] = now, now
        now = ends_inside(lines[i].as_py(), now)
        after[i], at = now, i + 1
    before[at:], after[at:] = now, now
    blank = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
    return before, after, ~before & ~blank


UNITS = "path string, block long, bytes long, seq long, value string, blank boolean, n0 long, e0 boolean, m0 long, e1 boolean, m1 long"


def _follow(batches):
    """Lines put together as if their block began outside quotes: number of the first line, records begun before and up to here, state after; the last two also for the other case."""
    block, bytes_, held, seq, now, begun = None, 0, [], 0, [False, True], [0, 0]
    out: list[tuple] = []

    def close() -> None:
        if held:
            first, n, text = held[0][0], held[0][1], "\n".join(h[2] for h in held)
            out.append((*block, bytes_, first, text, not held[0][3], n, now[0], begun[0], now[1], begun[1]))
            held.clear()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
        names = [c.split() for c in UNITS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*rows), names)], names=[n for n, _ in names])

    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks, sizes = batch.column("path").to_pylist(), batch.column("block").to_pylist(), batch.column("bytes").to_pylist()
        cut = [0, *[i for i in range(1, len(paths)) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]], len(paths)]
        for a, b in zip(cut[:-1], cut[1:]):
            if block != (paths[a], blocks[a]):
                close()
                block, bytes_, seq, now, begun = (paths[a], blocks[a]), sizes[a], 0, [False, True], [0, 0]
            lines = batch.column("value").slice(a, b - a)
            (s0, e0, g0), (_, e1, g1) = (_states(lines, case) for case in now)
            up0, up1 = begun[0] + np.cumsum(g0), begun[1] + np.cumsum(g1)
            for i, line in enumerate(lines.to_pylist()):
                if not s0[i]:
                    close()
                held.append((seq + i, int(up0[i] - g0[i]), line, bool(g0[i])))
                now, begun = [bool(e0[i]), bool(e1[i])], [int(up0[i]), int(up1[i])]
                if not e0[i]:
                    close()
            seq += b - a
        if out:
            yield batch_of(out)
            out = []
    close()
    if out:
        yield batch_of(out)


def stored_units(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """All lines of the files, put together to records as far as their block shows them, stored: the only read of the files."""
    text = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    rows = text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("bytes"))
    return durable(rows.mapInArrow(_follow, UNITS), "units")


def block_starts(units: DataFrame) -> DataFrame:
    """inside, ends, first and before of each (path, block): whether it begins and ends inside quotes, the records begun in the file before it, and those of all files before, without headers; stored."""
    # numbers of records grow with the lines, and states go with the number of the last line: buffers of fixed size, so that no task sorts its units
    state = F.max(F.col("seq") * 4 + F.col("e0").cast("long") * 2 + F.col("e1").cast("long")).alias("state")
    blocks = units.groupBy("path", "block").agg(state, F.max("m0").alias("m0"), F.max("m1").alias("m1"))
    bit = lambda n, name: (F.col("state").bitwiseAND(n) != 0).alias(name)
    blocks = blocks.select("path", "block", F.struct(bit(2, "e0"), bit(1, "e1"), "m0", "m1").alias("last"))
    by_file = blocks.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("block", "last"))).alias("blocks"))  # one entry for each block of the file
    none = F.array().cast("array<struct<block:bigint,inside:boolean,ends:boolean,first:bigint>>")
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("first"), none.alias("out"))

    def step(a, b):
        ends = F.when(a["inside"], b["last"]["e1"]).otherwise(b["last"]["e0"])
        begun = F.when(a["inside"], b["last"]["m1"]).otherwise(b["last"]["m0"])
        entry = F.struct(b["block"].alias("block"), a["inside"].alias("inside"), ends.alias("ends"), a["first"].alias("first"))
        return F.struct(ends.alias("inside"), (a["first"] + begun).alias("first"), F.concat(a["out"], F.array(entry)).alias("out"))

    walked = by_file.select("path", F.aggregate("blocks", start, step).alias("a"))
    before = F.sum(F.greatest(F.col("a.first") - 1, F.lit(0))).over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    return durable(walked.withColumn("before", F.coalesce(before, F.lit(0))).select("path", "before", F.inline("a.out")), "blocks")


PARTS = "value string, path string, block long, bytes long, before long, number long, seq long, whole boolean"


def _again(table: pa.Table) -> pa.Table:
    """The lines of a block that begins inside quotes, put together anew."""
    table = table.sort_by("seq")
    lines = pa.array([line for unit in table.column("value").to_pylist() for line in unit.split("\n")], pa.string())
    before, after, begins = _states(lines, True)
    heads = np.flatnonzero(~before)
    bounds = [*([0] if before[:1].any() else []), *heads.tolist(), len(lines)]
    texts, first, out = lines.to_pylist(), table.column("first")[0].as_py(), []
    count = first + np.cumsum(begins)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if before[a] or begins[a]:  # a blank line outside quotes is nothing
            out.append(("\n".join(texts[a:b]), int(count[a]) - 1, a, bool(not before[a] and not after[b - 1])))
    value, number, seq, whole = zip(*out) if out else ((),) * 4
    same = {c: pa.array([table.column(c)[0].as_py()] * len(out), t) for c, t in (("path", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("before", pa.int64()))}
    return pa.table({"value": pa.array(value, pa.string()), **same, "number": pa.array(number, pa.int64()), "seq": pa.array(seq, pa.int64()), "whole": pa.array(whole, pa.bool_())})


def records(units: DataFrame) -> DataFrame:
    """value, path, block, bytes, number (in its file, the header is 0) and position (over all files, headers not counted) of every record."""
    blocks = block_starts(units)
    side = blocks.select(F.xxhash64("path").alias("at"), "block", "inside", "first", "before")
    joined = units.withColumn("at", F.xxhash64("path")).join(F.broadcast(side) if small_enough(side, BLOCKS) else side, ["at", "block"])
    right = joined.where(~F.col("inside") & ~F.col("blank")).withColumns({"number": F.col("first") + F.col("n0"), "whole": ~F.col("e0")})
    names = [c.split()[0] for c in PARTS.split(", ")]
    parts, every = right.select(*names), right.where("whole").select(*names[:6])
    if not blocks.where("inside OR ends").isEmpty():
        wrong = joined.where("inside").select("value", "path", "block", "bytes", "seq", "first", "before")
        mended = durable(wrong.groupBy("path", "block").applyInArrow(_again, PARTS), "mended")
        torn = parts.where(~F.col("whole")).unionByName(mended.where(~F.col("whole"))).groupBy("path", "number").agg(
            F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"), F.first("bytes").alias("bytes"), F.first("before").alias("before")
        )
        torn = torn.select(F.array_join(F.col("parts.value"), "\n").alias("value"), "path", F.col("parts")[0]["block"].alias("block"), "bytes", "before", "number")
        every = every.unionByName(mended.where("whole").select(*names[:6])).unionByName(torn)
    return every.select(F.regexp_replace("value", r"\r$", "").alias("value"), "path", "block", "bytes", "number", (F.col("before") + F.col("number") - 1).alias("position"))


def column_names(header: str) -> list[str]:
    """Names of the columns of a header line; empty ones by their place, repeated ones with it."""
    cells = next(csv.reader([header.removeprefix(BYTE_ORDER_MARK).rstrip("\r")]), [])
    lower = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def parsed(rows: DataFrame, header: str) -> DataFrame:
    """Records as text columns under the names of their header, with FILE, BLOCK, BYTES and POSITION."""
    names = column_names(header)
    cells = F.from_csv("value", ", ".join(f"`{n.replace('`', '``')}` string" for n in names), {"escape": '"'})
    placed = rows.select(cells.alias("c"), F.col("path").alias(FILE), F.col("block").alias(BLOCK), F.col("bytes").alias(BYTES), F.col("position").alias(POSITION))
    return placed.select(*[F.col("c").getField(n).alias(n) for n in names], FILE, BLOCK, BYTES, POSITION)


def read_records(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """All records of the files as texts, by header; files whose headers differ have missing columns. Line breaks in a header are not supported."""
    units = stored_units(spark, path, pattern)
    heads = units.where("block = 0 AND seq = 0").select("path", F.regexp_replace(F.ltrim(F.col("value"), F.lit(BYTE_ORDER_MARK)), r"\r$", "").alias("header"))
    found = sorted(r.header for r in heads.select("header").distinct().collect())  # distinct headers only
    rows = records(units).where("number > 0")
    if len(found) > 1:
        side = F.broadcast(heads) if small_enough(heads) else heads
        rows = rows.join(side, "path")
    if not found:
        return rows.select(F.col("path").alias(FILE), F.col("block").alias(BLOCK), F.col("bytes").alias(BYTES), F.col("position").alias(POSITION))
    parts = [parsed(rows.where(F.col("header") == h) if len(found) > 1 else rows, h) for h in found]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def headers(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """path and header of each file, read by tasks that stop after the first line of their range."""

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                if batch.column("block")[0].as_py() == 0:
                    yield batch.slice(0, 1).select(["path", "header"])
                return

    name, alone = "spark.sql.files.openCostInBytes", str(1 << 40)  # every range is a task of its own
    before = spark.conf.get(name)
    spark.conf.set(name, alone)
    try:
        text = spark.read.option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("block"))
        return durable(text.mapInArrow(first, "path string, header string"), "headers")
    finally:
        spark.conf.set(name, before)


def first_records(spark: SparkSession, path: str, count: int, pattern: str = "*.csv", breaks: bool = True) -> list[tuple[str, list[str]]]:
    """(header, records) of the first files, by path, until there are ``count`` records.

    Of each file as many lines are taken as it needs, so that what is read does not depend on the size of the folder or of its files. Breaks in quotes are followed from the first line on,
    unless there are none (``breaks``).
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")
    out, missing = [], count
    for file in sorted(r.path for r in listed.collect()):  # paths only
        text, size = spark.read.option("lineSep", "\n").text(file), missing + 1
        while True:
            lines = [r.value for r in text.limit(size).collect()]
            found: list[list[str]] = []
            inside = False
            for line in lines:
                if inside:
                    found[-1].append(line)
                elif line.strip():
                    found.append([line])
                else:
                    continue
                inside = breaks and ends_inside(line, inside)
            if len(lines) < size or len(found) > missing + 1 or (len(found) == missing + 1 and not inside):
                break
            size *= 2
        joined = ["\n".join(r).removesuffix("\r") for r in found[: missing + 1]]
        if joined:
            out.append((joined[0].removeprefix(BYTE_ORDER_MARK), joined[1:]))
            missing -= len(joined) - 1
        if missing <= 0:
            break
    return out
