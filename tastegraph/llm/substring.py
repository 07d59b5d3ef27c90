"""Removal of word windows that an earlier document already has.

Every window of ``size`` words of every whole text gets a Rabin-Karp hash. Equal windows
hold equal n-grams, hence the same smallest n-gram hash, their minimizer. Consecutive
windows mostly share it, so a text is a sequence of runs with one minimizer each, about
one per 20 words, and Spark counts runs first: windows whose minimizer is in one document
only cannot repeat. Of the other runs, equal ones (by a digest of their window hashes) are
counted once, with the smallest document that has them; where a minimizer has different
runs, their windows are counted one by one. A hot passage so shrinks to a few rows before
it meets anything. Windows found in a smaller document become intervals of words, merged
to maximal ones when the texts are cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import FILTER_BITS, id_filter, may_hold, stage

_SHIFT = np.uint64(64 - FILTER_BITS)
_GRAM = 8
#: Stands for a missing id in comparisons: not smaller than any other.
_LAST = (1 << 63) - 1


class _Runs:
    """Runs of windows of a block: row, place in the row, minimizer, window count, digest."""

    def __init__(self, block: words.Block, size: int):
        hashes = block.hashes()
        gram = min(_GRAM, size)
        self.windows = words.rolling(hashes, size)
        row = np.repeat(np.arange(block.rows), block.count)
        span = size - gram + 1
        least = words.grams(hashes, gram)
        done = 1
        while done * 2 <= span:  # smallest of 1, 2, 4, ... neighbours
            least = np.minimum(least[:-done], least[done:]) if len(least) > done else least[:0]
            done *= 2
        if done < span:
            rest = span - done
            least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
        count = len(self.windows)
        valid = row[:count] == row[size - 1 : size - 1 + count]
        fresh = np.ones(count, bool)
        fresh[1:] = (least[1:] != least[:-1]) | ~valid[:-1] | (row[1:count] != row[: max(0, count - 1)])
        self.begin = np.flatnonzero(valid & fresh)
        ends = np.append(self.begin, count)
        total = np.concatenate([[0], np.cumsum(valid)])
        self.count = total[ends[1:]] - total[ends[:-1]]
        self.minimizer = least[self.begin]
        self.row = row[self.begin]
        self.start = self.begin - block.first[self.row] if len(self.begin) else self.begin
        held = np.where(valid, self.windows, np.uint64(0))
        summed = np.add.reduceat(held, self.begin) if len(self.begin) else np.zeros(0, np.uint64)
        first = self.windows[self.begin] * np.uint64(0x9E3779B97F4A7C15)
        self.digest = words.mix(summed + first + self.count.astype(np.uint64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(F.col(id_col), text)
    return docs.select(F.col(id_col).alias("id"), key.alias("key"), text.alias("text"))


def _all_runs(rows: DataFrame, size: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for block in words.blocks(batch.column(2)):
                runs = _Runs(block, size)
                at = pa.array(runs.row + block.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array(runs.minimizer.view(np.int64)),
                        pa.array(runs.digest.view(np.int64)),
                        pa.array(runs.start.astype(np.int32)),
                        pa.array(runs.count.astype(np.int32)),
                    ],
                    ["id", "key", "minimizer", "digest", "start", "n"],
                )

    ordered = rows.withColumn("id", F.coalesce(F.col("id").cast("long"), F.lit(_LAST)))
    return ordered.mapInArrow(work, "id long, key long, minimizer long, digest long, start int, n int")


def _run_windows(rows: DataFrame, wanted, size: int) -> DataFrame:
    """(key, start, hashes) of the runs that pass the bitmaps of keys and minimizers."""

    def work(batches):
        keys, minimizers = wanted.value
        for batch in batches:
            own = batch.column(0).to_numpy()
            chosen = np.flatnonzero(may_hold(keys, own.view(np.uint64) >> _SHIFT))
            taken = batch.take(pa.array(chosen, pa.int64()))
            for block in words.blocks(taken.column(1)):
                runs = _Runs(block, size)
                pick = np.flatnonzero(may_hold(minimizers, runs.minimizer >> _SHIFT))
                windows = [runs.windows[b : b + n].view(np.int64) for b, n in zip(runs.begin[pick], runs.count[pick], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column(0).take(pa.array(runs.row[pick] + block.row)),
                        pa.array(runs.start[pick].astype(np.int32)),
                        pa.array(windows, pa.list_(pa.int64())),
                    ],
                    ["key", "start", "hashes"],
                )

    return rows.select("key", "text").mapInArrow(work, "key long, start int, hashes array<long>")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50) -> DataFrame:
    """(key, spans): per document with repeated windows, arrays of (first window, count).

    ``key`` is the hash of id and text. A window counts as repeated if its words also
    start in a document with a smaller id.
    """
    spark = docs.sparkSession
    rows = _keyed(docs, id_col, text_col)
    runs = stage(_all_runs(rows, size), "runs")
    shared = runs.groupBy("minimizer").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    runs = stage(runs.join(shared.select("minimizer"), "minimizer"), "runs")
    one = F.min(F.struct("id", "key", "start", "n")).alias("one")
    contents = stage(runs.groupBy("minimizer", "digest").agg(one), "contents")
    mixed = contents.groupBy("minimizer").agg(F.count("*").alias("kinds")).where("kinds > 1").select("minimizer")
    open_runs = stage(
        contents.join(mixed, "minimizer").select("minimizer", "digest", "one.id", "one.key", "one.start"), "open"
    )
    top = [id_filter(open_runs, F.shiftrightunsigned(c, int(_SHIFT))) for c in ("key", "minimizer")]
    bitmaps = spark.sparkContext.broadcast(top)
    windows = _run_windows(rows, bitmaps, size).dropDuplicates(["key", "start"]).join(open_runs, ["key", "start"])
    windows = windows.select("minimizer", "digest", "id", F.posexplode("hashes").alias("at", "window"))
    windows = stage(windows, "windows")
    least = windows.groupBy("window").agg(F.min("id").alias("low"))
    # The smallest document of each window, back in the order of the run.
    lows = (
        windows.select("minimizer", "digest", "at", "window")
        .join(least, "window")
        .groupBy("minimizer", "digest")
        .agg(F.array_sort(F.collect_list(F.struct("at", "low"))).alias("lows"))
        .select("minimizer", "digest", F.col("lows.low").alias("lows"))
    )
    known = contents.select("minimizer", "digest", F.col("one.id").alias("low")).join(lows, ["minimizer", "digest"], "left")
    found = runs.join(known, ["minimizer", "digest"]).where("low < id OR lows IS NOT NULL")
    whole = F.when(F.col("low") < F.col("id"), F.array(F.struct("start", "n")))
    single = F.expr(
        "transform(filter(sequence(0, n - 1), i -> lows[i] < id), i -> struct(start + i AS start, 1 AS n))"
    )
    spans = found.select("key", F.when(F.col("low") < F.col("id"), whole).otherwise(single).alias("spans"))
    spans = spans.where(F.size("spans") > 0)
    return spans.groupBy("key").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50) -> DataFrame:
    """(id, n_words, n_removed, kept) per document: kept words joined by one space.

    Null and empty texts have no words. A text shorter than ``size`` words keeps all. Of
    equal ids no document is the smaller one, so repeated rows do not remove each other;
    rows without an id are not smaller than any. Other columns are ignored.
    """
    spans = repeated_windows(docs, id_col, text_col, size)
    spans = stage(spans.select(F.col("key"), F.col("spans.start").alias("starts"), F.col("spans.n").alias("counts")), "spans")

    def work(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            starts, counts = batch.column("starts"), batch.column("counts")
            for block in words.blocks(batch.column("text")):
                for row in range(block.rows):
                    parts = block.text(row).split()
                    drop = starts[block.row + row].as_py()
                    if drop:
                        edge = np.zeros(len(parts) + 1, np.int64)
                        first = np.array(drop)
                        np.add.at(edge, first, 1)
                        np.add.at(edge, first + np.array(counts[block.row + row].as_py()) + size - 1, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        left = [parts[i] for i in np.flatnonzero(stay)]
                    else:
                        left = parts
                    n_words.append(len(parts))
                    n_removed.append(len(parts) - len(left))
                    kept.append(b" ".join(left))
                if sum(map(len, kept)) > 1 << 22:
                    yield batch_of(batch, block.row + block.rows - len(kept), n_words, n_removed, kept)
                    n_words, n_removed, kept = [], [], []
            if kept:
                yield batch_of(batch, len(batch) - len(kept), n_words, n_removed, kept)

    def batch_of(batch, low, n_words, n_removed, kept):
        digest = [hashlib.sha256(k).hexdigest() for k in kept]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").slice(low, len(kept)),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(digest),
            ],
            ["id", "n_words", "n_removed", "kept", "kept_sha256"],
        )

    joined = _keyed(docs, id_col, text_col).join(spans, "key", "left").select("id", "text", "starts", "counts")
    kind = joined.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(work, f"id {kind}, n_words long, n_removed long, kept string, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)
