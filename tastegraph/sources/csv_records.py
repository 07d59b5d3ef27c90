"""CSV whose quoted fields hold line ends, read by many tasks from one file.

Spark's own reader must take such a file whole, since a split cannot know whether its
first line end is inside quotes. Here the file is read as lines, split as usual. One pass
counts the quotes of every split; the parity of all quotes before a split tells whether it
begins inside a quoted field. A second pass puts the lines of each split together to
records, and the pieces of records that cross splits, two per split at most, are joined up.
Spark's CSV expression then parses every record.

Fields must be quoted as RFC 4180 has it: a field with a quote in it is quoted, and quotes
in it are doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

WHOLE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3
#: Bytes of records that are handed on at once.
BATCH_BYTES = 1 << 22


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in order with the split that each begins in; only ``\\n`` ends a line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    file, start = F.xxhash64(F.col("_metadata.file_path")), F.col("_metadata.file_block_start")
    return lines.select(file.alias("file"), start.alias("split"), "value")


def split_parities(lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(file, split, parity): whether each split begins inside quotes, sorted by both.

    17 bytes per split of ``spark.sql.files.maxPartitionBytes`` go through the driver, less
    than what it holds of a split to plan the scan.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("byte").alias("odd")
    found = counts.select("file", "split", odd).toArrow().sort_by([("file", "ascending"), ("split", "ascending")])
    return tuple(found[name].to_numpy() for name in ("file", "split", "odd"))


class _Assembler:
    """Puts the lines of one split together, given whether it begins inside quotes."""

    def __init__(self, file: int, split: int, inside: bool):
        self.at = (file, split)
        self.inside, self.leading, self.first = inside, inside, split == 0 and not inside
        self.open: list[str] = []

    def add(self, line: str) -> tuple | None:
        """The record that the line ends, if any: (file, split, kind, first of its file, text)."""
        self.open.append(line)
        if line.count('"') % 2:
            self.inside = not self.inside
        if self.inside:
            return None
        out = (*self.at, HEAD if self.leading else WHOLE, self.first, "\n".join(self.open))
        self.open, self.leading, self.first = [], False, False
        return out

    def rest(self) -> tuple | None:
        if not self.open:
            return None
        return (*self.at, MIDDLE if self.leading else TAIL, self.first, "\n".join(self.open))


def _assembled(parities):
    files, splits, odd = parities

    def begins_inside(file: int, split: int) -> bool:
        low, high = np.searchsorted(files, file), np.searchsorted(files, file, "right")
        return bool(odd[low + np.searchsorted(splits[low:high], split)])

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        names = ["file", "split", "kind", "first", "record"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, rows, held = None, [], 0
        for batch in batches:
            places = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for file, split, line in places:
                if one is None or one.at != (file, split):
                    if one is not None and (last := one.rest()):
                        rows.append(last)
                    one = _Assembler(file, split, begins_inside(file, split))
                record = one.add(line)
                if record:
                    rows.append(record)
                    held += len(record[4])
                    if held > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
        if one is not None and (last := one.rest()):
            rows.append(last)
        if rows:
            yield batch_of(rows)

    return work


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): the text of every record, without the first of each file if it is a header."""
    lines = _lines(spark, path)
    rows = lines.mapInArrow(_assembled(split_parities(lines)), "file long, split long, kind int, first boolean, record string")
    pieces = rows.where(F.col("kind") != WHOLE)
    # A record begins with a tail; what follows up to the next head belongs to it. The head
    # of a split comes before its tail.
    order = Window.partitionBy("file").orderBy("split", "kind")
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    texts = F.array_sort(F.collect_list(F.struct("split", "kind", "record"))).getField("record")
    joined = (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_join(texts, "\n").alias("record"))
    )
    whole = rows.where(F.col("kind") == WHOLE).select("first", "record").unionByName(joined.select("first", "record"))
    kept = whole.where(~F.col("first")) if header else whole
    return kept.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def scan_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """Rows of a CSV file or folder whose quoted texts may span lines; quotes are doubled.

    Line ends inside quotes stay as they are written.
    """
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = F.from_csv("record", schema.toDDL(), options)
    return csv_records(spark, path, header).select(parsed.alias("row")).select("row.*")
