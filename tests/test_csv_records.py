"""CSV records that span lines, read in splits, against Spark's reader of whole files."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from tastegraph.sources.csv_records import csv_records, scan_csv, split_parities, _lines

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.IntegerType())]
)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "text", "n"])
        writer.writerows(rows)


def texts(count, seed=1):
    rng = random.Random(seed)
    parts = ['"', '""', "\n", "\n\n", ",", " ", "é", "😀", "word", "more words", "\r\n", "x" * 30]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(12))) or "none", rng.randrange(100)) for i in range(count)]


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def splits(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield splits
    for key, value in kept.items():
        spark.conf.set(key, value)


def whole_file(spark, path):
    reader = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"')
    return sorted(map(tuple, reader.csv(str(path)).collect()))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [64, 700, 1 << 20])
def test_split_reading_equals_whole_file(spark, tmp_path, small_splits, end, size):
    path = tmp_path / "rows.csv"
    rows = texts(400)
    write(path, rows, end)
    if end == "\n":  # else Spark's reader turns the line ends inside quotes into \n
        assert whole_file(spark, path) == sorted(rows)
    small_splits(size)
    lines = _lines(spark, str(path))
    if size == 64:
        assert lines.rdd.getNumPartitions() > 100
        assert set(split_parities(lines)[2]) == {0, 1}
    got = sorted(map(tuple, scan_csv(spark, str(path), SCHEMA).collect()))
    assert got == sorted(rows)


def test_record_longer_than_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    long = "\n".join(f'line {i} "quoted", {i}' for i in range(300))
    write(path, [(1, "a", 1), (2, long, 2), (3, "b\n", 3), (4, long[:50], 4)])
    small_splits(100)
    got = {r["id"]: r["text"] for r in scan_csv(spark, str(path), SCHEMA).collect()}
    assert got == {1: "a", 2: long, 3: "b\n", 4: long[:50]}


def test_folders_headers_blank_lines_and_empty_files(spark, tmp_path, small_splits):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "a.csv", [(1, "x\ny", 1)])
    write(folder / "b.csv", [(2, 'say "hi"', 2)])
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("id,text,n\n\n3,,\n\n")
    small_splits(16)
    assert sorted(map(tuple, scan_csv(spark, str(folder), SCHEMA).collect())) == [(1, "x\ny", 1), (2, 'say "hi"', 2), (3, None, None)]
    assert csv_records(spark, str(folder), header=False).count() == 6
