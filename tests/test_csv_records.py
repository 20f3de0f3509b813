"""Records with line breaks from small blocks, beside the file parsed in one piece."""

import csv
import io
import random

import pytest

from tasador.sources import csv_records, listing_files
from tasador.sources.listing_files import load_listings


def inside_of(text: str) -> bool:
    """Plain automaton: is the end of a text inside quotes?"""
    inside, fresh, i = False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                inside, fresh = False, False
        elif c == '"' and fresh:
            inside = True
        else:
            fresh = c in ",\n"
        i += 1
    return inside


@pytest.mark.parametrize("line", ["", "a,b", '"a', '"a"', 'a"b', '"a""', '"a"",b"', ',"', 'x,"a ""b"" c', '"a"x"y,"z', '5" pipe,"long', '""', '"""', '"""",b"'])
def test_state_after_a_line(line):
    assert csv_records.ends_inside(line, False) == inside_of(line)
    assert csv_records.ends_inside(line, True) == inside_of('"\n' + line)


def cell(rng):
    plain = ["", "a", "b c", 'say "hi"', '5" pipe', "comma, here", "ñandú 漢字", "x" * 40]
    broken = ["two\nlines", '\n\n"quoted"\n', "a,\nb", 'end"\n', "\n" + "long line " * 8 + "\n\n", "1\n2\n3\n4,5\n"]
    return rng.choice(plain if rng.random() < 0.6 else broken)


@pytest.mark.parametrize("seed, ending, size", [(1, "\n", 64), (2, "\n", 150), (3, "\r\n", 97), (4, "\n", 100_000)])
def test_small_blocks_give_the_same_rows(spark, tmp_path, seed, ending, size):
    rng = random.Random(seed)
    want = []
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = [[str(len(want) + i), cell(rng), cell(rng)] for i in range(rng.choice([0, 5, 120]) if name != "b.csv" else 120)]
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=ending)
        writer.writerow(["l1", "note", "more"])
        for i, r in enumerate(rows):
            writer.writerow(r)
            if i % 17 == 3:
                out.write(ending)  # blank lines are no rows
        (tmp_path / name).write_bytes(out.getvalue().encode())
        want += rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        texts = listing_files.read_csv(spark, str(tmp_path))
        got = sorted(texts.collect(), key=lambda r: r[csv_records.POSITION])
        units = csv_records.stored_units(spark, str(tmp_path), "*.csv")
        blocks = csv_records.block_starts(units)
        assert size > 1000 or (blocks.count() > 20 and blocks.where("inside").count() > 3)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[csv_records.POSITION] for r in got] == list(range(len(want)))
    assert [(r.l1, r.note or "", r.more or "") for r in got] == [tuple(r) for r in want]


def test_ordinary_quotes_and_an_open_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('l1,note\n1,5" pipe\n2,"a ""b""\nc"\n3,x"y"\n4,"never closed\nat all\n', encoding="utf-8")
    rows = load_listings(spark, str(tmp_path)).orderBy("property_id").collect()
    assert [(r.property_id, r.l1, r.note) for r in rows[:3]] == [("0", "1", '5" pipe'), ("1", "2", 'a "b"\nc'), ("2", "3", 'x"y"')]
    assert len(rows) == 4 and rows[3].l1 == "4"


def test_empty_files_and_a_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_text("", encoding="utf-8")
    (tmp_path / "b.csv").write_text("﻿l1,,l1\nA,B,C\n", encoding="utf-8")
    got = listing_files.read_csv(spark, str(tmp_path)).drop(*listing_files.PLACE)
    assert got.columns == ["l10", "_c1", "l12"] and [tuple(r) for r in got.collect()] == [("A", "B", "C")]
    (tmp_path / "b.csv").write_text("l1\n", encoding="utf-8")
    assert load_listings(spark, str(tmp_path)).collect() == []


def input_bytes(spark) -> int:
    jvm = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, jvm.new_array(jvm.jvm.double, 0), jvm.jvm.java.util.ArrayList())
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def test_a_probe_reads_as_much_of_a_large_folder_as_of_a_small_one(spark, tmp_path):
    for name, files in (("small", 1), ("large", 6)):
        (tmp_path / name).mkdir()
        for k in range(files):
            (tmp_path / name / f"{k}.csv").write_text("l1,note\n" + "".join(f'{i},"a\n{k} {i} {"x" * 200}"\n' for i in range(20_000)), encoding="utf-8")
    read = []
    for name in ("small", "large"):
        before = input_bytes(spark)
        rows = listing_files.probe(spark, str(tmp_path / name), 50).collect()
        read.append(input_bytes(spark) - before)
        assert [r.property_id for r in rows] == [str(i) for i in range(50)] and rows[49].note.startswith("a\n0 49 x")
    assert read[1] <= read[0] * 1.5 < 2_000_000 and read[0] > 0


def test_a_probe_goes_on_in_the_next_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(("l1,price\n" if k != 1 else "price,l1,l2\n") + "".join(f"{i},{k}{',z' if k == 1 else ''}\n" for i in range(4)), encoding="utf-8")
    rows = listing_files.probe(spark, str(tmp_path), 10).collect()
    assert [int(r.property_id) for r in rows] == list(range(10)) and [r.price for r in rows] == [0.0] * 4 + [0.0, 1.0, 2.0, 3.0] + [2.0] * 2 and rows[5].l2 == "z"


def test_headers_come_from_the_tasks(spark, tmp_path):
    big = "id,note\n" + "".join(f"{i},{'y' * 50}\n" for i in range(3000))
    (tmp_path / "a b.csv").write_text(big, encoding="utf-8")
    (tmp_path / "c.csv").write_text("note,id\nq,1\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        found = {r.path.rsplit("/", 1)[1]: r.header for r in csv_records.headers(spark, str(tmp_path)).collect()}
        rows = listing_files.read_csv(spark, str(tmp_path), multiline=False)
        assert rows.count() == 3001 and rows.where("id = '1'").count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {"a%20b.csv": "id,note", "c.csv": "note,id"}


def test_ends_of_blocks_are_found_without_a_sort_of_the_lines(spark, monkeypatch):
    """The last unit of a block tells how it ends, in whatever order units come."""
    plans = []
    monkeypatch.setattr(csv_records, "durable", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    rows = [("a", 0, 9, 4, "x", False, 1, True, 2, False, 1), ("a", 0, 9, 0, "x", False, 0, False, 1, True, 0), ("a", 5, 9, 3, "x", False, 3, True, 4, False, 2), ("a", 5, 9, 1, "x", False, 0, False, 1, False, 1),
            ("b", 0, 9, 0, "x", False, 0, False, 3, True, 2)]
    units = spark.createDataFrame(rows, csv_records.UNITS).repartition(3)
    got = sorted((r.path, r.block, r.inside, r.ends, r.first, r.before) for r in csv_records.block_starts(units).collect())
    assert got == [("a", 0, False, True, 0, 0), ("a", 5, True, False, 2, 0), ("b", 0, False, False, 0, 3)]
    assert "SortAggregate" not in plans[0]
