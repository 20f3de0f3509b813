from pathlib import Path

import pytest

from tasador.operators.reports import write_csv
from tasador.sources import listing_files
from tasador.sources.listing_files import load_listings


def write(tmp_path: Path, name: str, text: str) -> str:
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_types_missing_texts_and_quotes(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,l1,price,rooms,note\n7,Argentina,10.5,3,"two\nlines, ""quoted"""\n8,NA,nan,,N/A\n9, x ,1e3,2.0,\n')
    got = load_listings(spark, path).collect()
    assert [tuple(r) for r in got] == [
        ("7", "Argentina", 10.5, 3.0, 'two\nlines, "quoted"', "7"), ("8", None, None, None, None, "8"), ("9", " x ", 1000.0, 2.0, None, "9"),
    ]


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id,lat,floor,code,empty\n1,1.5,2,a1,\n2,NA,3,7,\n")
    kinds = dict(load_listings(spark, path, infer=True).dtypes)
    assert kinds == {"id": "string", "lat": "double", "floor": "bigint", "code": "string", "empty": "double", "property_id": "string"}
    assert dict(load_listings(spark, path).dtypes)["lat"] == "string"


def test_key_without_id_is_the_row_position(spark, tmp_path):
    for i in range(3):
        write(tmp_path, f"part{i}.csv", "l1,price\n" + "".join(f"c{i},{k}\n" for k in range(5 + i)))
    df = load_listings(spark, str(tmp_path), multiline=False)
    rows = df.collect()
    assert sorted(int(r.property_id) for r in rows) == list(range(18))
    ordered = sorted(rows, key=lambda r: int(r.property_id))
    for file in ("c0", "c1", "c2"):
        prices = [r.price for r in ordered if r.l1 == file]
        assert prices == sorted(prices)


def test_row_position_over_many_tasks(spark, folder):
    spark.range(0, 1000, 1, 7).write.parquet(folder)
    rows = listing_files.add_row_position(spark.read.parquet(folder), "position").collect()
    assert sorted(r.position for r in rows) == list(range(1000))


def test_all_csv_files_of_a_folder_and_nothing_else(spark, tmp_path):
    write(tmp_path, "a.csv", "id,l1\n1,A\n")
    write(tmp_path, "b.csv", "id,l1\n2,B\n")
    write(tmp_path, "c.txt", "id,l1\n3,C\n")
    assert {r.id for r in load_listings(spark, str(tmp_path)).collect()} == {"1", "2"}
    with pytest.raises(Exception):
        load_listings(spark, str(tmp_path / "absent"))


def test_headers_that_differ(spark, tmp_path):
    write(tmp_path, "a.csv", "id,price,surface_total\n1,100,50\n")
    write(tmp_path, "b.csv", "surface_total,id,price,l1\n51,2,101,A\n")
    rows = load_listings(spark, str(tmp_path)).orderBy("id").select("id", "price", "surface_total", "l1").collect()
    assert [tuple(r) for r in rows] == [("1", 100.0, 50.0, None), ("2", 101.0, 51.0, "A")]
    assert listing_files.dataset_info(listing_files.read_csv(spark, str(tmp_path))).first().n_files == 2


def test_positions_follow_the_files(spark, tmp_path):
    for name, n in (("a", 2), ("b", 400), ("c", 3)):
        write(tmp_path, f"{name}.csv", "l1\n" + "".join(f"{name}{i}\n" for i in range(n)))
    rows = {int(r.property_id): r.l1 for r in load_listings(spark, str(tmp_path)).collect()}
    assert [rows[i] for i in (0, 1, 2, 401, 402, 404)] == ["a0", "a1", "b0", "b399", "c0", "c2"]


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    write(tmp_path, "a.csv", 'id,note\n1,"a\nb ""q"""\n2,c\n')
    big = "id,note\n" + "".join(f'{i},"say ""{i}"" again"\n' for i in range(10, 40_000))
    write(tmp_path, "b.csv", big)
    path = str(tmp_path)
    assert {p.rsplit("/", 1)[1] for p in listing_files.files_with_line_breaks(spark, path)} == {"a.csv"}
    rows = load_listings(spark, path)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, load_listings(spark, path, multiline=True).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert listing_files.read_csv(spark, path).rdd.getNumPartitions() > 5
        assert listing_files.read_csv(spark, path, multiline=True).rdd.getNumPartitions() <= 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_probe_reads_line_breaks_as_the_load_does(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,note\n1,"a\nb"\n2,c\n')
    assert listing_files.probe(spark, path).collect() == load_listings(spark, path).collect()


def test_probe_and_info(spark, tmp_path, raw):
    path = str(tmp_path / "out")
    write_csv(raw, path)
    assert listing_files.probe(spark, path, 10).count() == 10
    info = listing_files.dataset_info(listing_files.read_csv(spark, path)).first()
    assert info.total_rows == raw.count() and info.n_files == 1 and info.total_bytes > 1000


def test_csv_round_trip(spark, tmp_path, raw):
    path = str(tmp_path / "out")
    write_csv(raw, path)
    again = load_listings(spark, path).drop("property_id").select(raw.columns)
    assert again.exceptAll(raw).count() == 0 and again.count() == raw.count()
