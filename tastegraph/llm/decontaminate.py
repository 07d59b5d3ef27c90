"""Test items inside documents: size-partitioned MinHash containment search.

An item is contained in a document if at least ``percent`` of its distinct shingles occur
there, however long the document is. Similarity sketches of whole documents cannot see
that, so only items are sketched: an item keeps its k smallest shingle hashes. Items are
partitioned by set size into powers of two, and k follows from the upper bound of the
partition, such that a contained item has at least one of its k hashes in the document.
Documents look up all their shingles, whole texts, in a bitmap of fixed size made of the
sketches; what passes meets the sketches in a join, and each candidate pair is verified on
the exact shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import FILTER_BITS, given_back, id_filter, may_hold, plain, stage, text_key

_SHIFT = np.uint64(64 - FILTER_BITS)


def _sketch_size(size: int, percent: int) -> int:
    """Enough hashes for all items of the partition: any size from half the bound up to it."""
    bound = 1 << max(0, size - 1).bit_length()
    return min(size, bound - -(-percent * bound // 100) + 1)


def _item_sets(items: DataFrame, n: int, percent: int, item_col: str, text_col: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            width, sets, sketches = [], [], []
            for block in words.blocks(batch.column(1)):
                hashes = block.hashes(lower=True)
                for row in range(block.rows):
                    part = hashes[block.first[row] : block.first[row] + block.count[row]]
                    found = np.unique(words.shingles(part, n))
                    width.append(min(n, len(part)))
                    sets.append(found.view(np.int64))
                    sketches.append(found[: _sketch_size(len(found), percent) if len(found) else 0].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(width, pa.int32()), pa.array(sets, longs), pa.array(sketches, longs)],
                ["item", "width", "grams", "sketch"],
            )

    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).dropDuplicates()
    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(work, f"item {kind}, width int, grams array<long>, sketch array<long>").where("width > 0")
    # Items with one id and different texts stay apart.
    return found.withColumn("item_key", F.xxhash64("item", "grams"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 5,
    percent: int = 75,
) -> DataFrame:
    """(doc id, text_key, item id, n_item, n_shared) for each item that a document contains.

    Shingles are ``n`` words, A-Z lowered; a shorter item is one shingle and is searched at
    its own length. Null or empty texts, on either side, contain nothing and are in
    nothing. Repeated rows give one row; so do repeated items. Documents or items without
    an id are found like others. Other columns are ignored.
    """
    spark = docs.sparkSession
    sets = stage(_item_sets(items, n, percent, item_col, item_text_col), "items")
    # At most n different lengths.
    widths = sorted(r["width"] for r in sets.select("width").distinct().collect())
    bitmaps = []
    for column in ("sketch", "grams"):
        rows = sets.select(F.explode(column).alias("gram"))
        bitmaps.append(id_filter(rows, F.shiftrightunsigned("gram", int(_SHIFT))))
    both = spark.sparkContext.broadcast(bitmaps)

    def look_up(batches):
        sketched, known = both.value
        for batch in batches:
            rows, firsts, hits = [], [], []
            for block in words.blocks(batch.column(2)):
                hashes = block.hashes(lower=True)
                # All n-grams of the block at once; those across rows are left out below.
                grams = [words.grams(hashes, width) for width in widths]
                likely = [np.flatnonzero(may_hold(known, g >> _SHIFT)) for g in grams]
                for row in range(block.rows):
                    low, high = block.first[row], block.first[row] + block.count[row]
                    own = []
                    for width, gram, at in zip(widths, grams, likely, strict=True):
                        left, right = np.searchsorted(at, [low, max(low, high - width + 1)])
                        own.append(gram[at[left:right]])
                    own = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
                    first = own[may_hold(sketched, own >> _SHIFT)]
                    if len(first):
                        rows.append(block.row + row)
                        firsts.append(first.view(np.int64))
                        hits.append(own.view(np.int64))
            taken = batch.take(pa.array(rows, pa.int64()))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(firsts, longs), pa.array(hits, longs)],
                ["id", "text_key", "first", "hits"],
            )

    texts = docs.select(
        F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text")
    )
    kind = texts.schema[0].dataType.simpleString()
    found = texts.mapInArrow(look_up, f"id {kind}, text_key long, first array<long>, hits array<long>")
    found = stage(found.dropDuplicates(["id", "text_key"]).withColumn("doc", F.xxhash64("id", "text_key")), "hits")
    sketches = sets.select("item_key", F.explode("sketch").alias("gram"))
    pairs = found.select("doc", F.explode("first").alias("gram")).join(sketches, "gram").select("doc", "item_key").distinct()
    shared = F.size(F.array_intersect("hits", "grams")).cast("long")
    size = F.size("grams").cast("long")
    exact = (
        pairs.join(found.select("doc", "id", "text_key", "hits"), "doc")
        .join(sets.select("item_key", "item", "grams"), "item_key")
        .select("id", "text_key", "item", size.alias("n_item"), shared.alias("n_shared"))
    )
    exact = exact.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return exact.withColumnsRenamed({"id": id_col, "item": item_col})


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    hit = find_items(docs, items, id_col, text_col, **settings)
    hit = hit.select(F.col(id_col).alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    rows, at = plain(docs)
    rows = rows.withColumn("key", text_key(at[text_col]))
    same = (F.col("key") == F.col("hit_key")) & F.col(at[id_col]).eqNullSafe(F.col("hit_id"))
    return given_back(rows.join(hit, same, "left_anti"), docs)
