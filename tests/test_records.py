"""Multi-line CSV read in pieces, against Spark's own reader of whole files."""

import csv
import io
import random

import pytest

from clickcohort.sources import records
from clickcohort.sources.delimited import read_csv


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "96")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(rng):
    plain = rng.choice(["x", "", "12", "a b", 'in"ch', "é中", "N/A"])
    return rng.choice([plain, plain, '"' + rng.choice(
        ["", "a,b", 'say ""hi""', "two\nlines", "crlf\r\ninside", "\n\n", "long " * 40 + "\nend",
         'q""\n""q', ",\n,"]) + '"'])


def whole_files(spark, paths):
    frame = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(paths)
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_as_spark_reads_whole_files(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    paths = []
    for k in range(2):
        rows = [",".join(cell(rng) for _ in range(3)) for _ in range(60)]
        text = "\n".join(['"a\nhead",b,c', *rows]) + rng.choice(["", "\n"])
        path = tmp_path / f"f{k}.csv"
        path.write_bytes(text.encode())
        paths.append(str(path))
    found = records.parse_records(records.read_records(spark, paths), ["a\nhead", "b", "c"])
    assert records._lines(spark, paths).rdd.getNumPartitions() > 8
    assert sorted(map(str, found.drop("source_file").collect())) == whole_files(spark, paths)


def test_lines_that_end_in_two_characters(spark, tmp_path, small_blocks):
    rng = random.Random(11)
    text = "\r\n".join(["a,b,c", *[",".join(cell(rng) for _ in range(3)) for _ in range(60)]])
    path = tmp_path / "f.csv"
    path.write_bytes(text.encode())
    found = records.parse_records(records.read_records(spark, [str(path)]), ["a", "b", "c"])
    wanted = [tuple(c or None for c in row) for row in csv.reader(io.StringIO(text, newline=""))][1:]
    rows = [tuple(c or None for c in row) for row in found.drop("source_file").collect()]
    assert sorted(rows, key=str) == sorted(wanted, key=str)


def test_a_large_look_up_keeps_the_order(spark, tmp_path, small_blocks, monkeypatch):
    rng = random.Random(9)
    rows = [",".join(cell(rng) for _ in range(3)) for _ in range(80)]
    path = tmp_path / "f.csv"
    path.write_bytes("\n".join(["a,b,c", *rows]).encode())
    monkeypatch.setattr(records, "BROADCAST_BLOCKS", 0)
    found = records.parse_records(records.read_records(spark, [str(path)]), ["a", "b", "c"])
    assert sorted(map(str, found.drop("source_file").collect())) == whole_files(spark, [str(path)])


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i} of one cell" for i in range(60))
    path = tmp_path / "f.csv"
    path.write_text(f'a,b\n1,"{long}"\n2,x\n')
    rows = read_csv(spark, str(path), multi_line=True).orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("1", long), ("2", "x")]
    assert rows[0]["source_file"].endswith("f.csv")


def test_header_only_and_duplicate_names(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("ID,x,ID\n")
    out = read_csv(spark, str(path), multi_line=True)
    assert out.columns == ["ID0", "x", "ID2", "source_file"] and out.count() == 0


def test_line_states():
    assert not records.ends_inside('a,b"c,d', False)        # a quote that opens no field
    assert records.ends_inside('a,"b', False)
    assert records.ends_inside('a,"b""', False)
    assert not records.ends_inside('b"",x', False)
    assert not records.ends_inside('end",y', True)
    assert records.ends_inside('end","', True)
    assert records.ends_inside("", True) and not records.ends_inside("", False)
