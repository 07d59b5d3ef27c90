"""Importance resampling of documents by hashed n-gram models of target and raw text.

Both models are bags of hashed n-grams: words, byte trigrams and the share of words that
repeat the word before. Each n-gram counts once per document, so that a long or copied
passage weighs like one sighting. The raw model counts all documents, the target model
those labelled as wanted. A document's log weight is the sum of the log ratios of its
n-grams. Ratios have prior counts and are shrunk smoothly by how well the counts (their
binomial deviance) rule out chance, at every table size; they are relative to the typical
n-gram, so that length moves no document. Documents are drawn without replacement:
``sharpness`` times the log weight plus Gumbel noise, and the k largest stay, where k is
the number of documents whose log weight is at least ``floor``. The floor is where most
labelled documents come to the right side of it, wanted ones weighed as if unlabelled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import filter_place, free, given_back, id_filter, may_hold, plain, stage, text_key
from tastegraph.operators.ranking import assign_row_id, running_total

WORD_BITS, CHAR_BITS = 19, 16
#: A document has the n-th of these n-grams if so many of its words repeat the one before.
REPEATS = (1 / 8, 1 / 4, 1 / 2)
SLOTS = (1 << WORD_BITS) + (1 << CHAR_BITS) + len(REPEATS)
PRIOR, CHANCE, STEEPNESS = 1.0, 20.0, 3
#: The sharpness holds for a floor of this size; at another the weights count relative to it.
FLOOR, SHARPNESS, SEED = 6.0, 4.0, 20
_SCALE = 1 << 20


def _slots(block: words.Block):
    """Per row of the block: word slots, byte trigram slots, slots of the repeat shares."""
    hashes = block.hashes()
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    data = block.data.astype(np.uint32)
    three = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
    three = ((three * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)).astype(np.int64) + (1 << WORD_BITS)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    for row in range(block.rows):
        first, count = block.first[row], block.count[row]
        begin, end = block.edges[row], max(block.edges[row], block.edges[row + 1] - 2)
        repeated = np.count_nonzero(again[first + 1 : first + count])
        share = [SLOTS - len(REPEATS) + i for i, least in enumerate(REPEATS) if repeated and repeated >= least * (count - 1)]
        yield word[first : first + count], three[begin:end], np.array(share, np.int64)


def _wanted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (id, text) whose labels all say good and not toxic.

    A bitmap of fixed size lets few other texts through to the join, which is by sorting at
    every size, so the ids need not fit anywhere.
    """
    good = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    good = stage(good.where("__id IS NOT NULL AND q = 1 AND t = 0").select("__id"), "wanted")
    shared = rows.sparkSession.sparkContext.broadcast(id_filter(good, filter_place("__id")))

    def work(batches):
        for batch in batches:
            held = may_hold(shared.value, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["id", "text"]).filter(pa.array(held))

    known = rows.where("id IS NOT NULL").withColumn("place", filter_place("id"))
    likely = known.mapInArrow(work, "id long, text string")
    return likely.join(good.hint("merge"), F.col("id") == F.col("__id"), "left_semi")


def _sightings(rows: DataFrame) -> DataFrame:
    """(slot, n): documents that hold an n-gram; slot ``SLOTS`` counts the documents."""

    def count(batches):
        seen = np.zeros(SLOTS + 1, np.int64)
        for batch in batches:
            for block in words.blocks(batch.column(1)):
                for parts in _slots(block):
                    seen[np.unique(np.concatenate(parts))] += 1
                    seen[SLOTS] += 1
        used = np.flatnonzero(seen)
        for low in range(0, len(used), 1 << 16):
            part = used[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(seen[part].astype(np.int32))], ["slot", "n"])

    return rows.mapInArrow(count, "slot int, n int").groupBy("slot").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Log ratio per slot, and what it were for a wanted document without its label.

    The table's size is fixed; the counts cover all documents, and all labels.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sums = {kind: _sightings(part).toArrow() for kind, part in (("raw", rows), ("target", _wanted(rows, labels)))}
    raw, target = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for counts, found in ((raw, sums["raw"]), (target, sums["target"])):
        counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    if not target[SLOTS]:
        return np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32)
    expected = raw[:SLOTS] * target[SLOTS] / raw[SLOTS]
    target = target[:SLOTS]
    usual = (expected > 50) & (target > 0)
    if usual.any():
        # The median over sightings: what an n-gram of ordinary text has.
        ratio, weight = np.log(target[usual] / expected[usual]), target[usual]
        order = np.argsort(ratio)
        half = np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)
        expected *= np.exp(ratio[order][half])
    expected = np.minimum(expected, raw[:SLOTS])
    return _shrunk(raw[:SLOTS], target, expected), _shrunk(raw[:SLOTS], np.maximum(target - 1, 0), expected)


def _shrunk(raw: np.ndarray, target: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Log ratios with prior counts, drawn to 0 as far as chance explains the counts."""

    def part(seen, hoped):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(hoped, 1e-9)), 0)

    deviance = np.maximum(2 * (part(target, expected) + part(raw - target, raw - expected)), 0)
    ratio = np.log((target + PRIOR) / (expected + PRIOR))
    return (ratio * (deviance / (deviance + CHANCE)) ** STEEPNESS).astype(np.float32)


def choose_floor(weights: DataFrame, labels: DataFrame) -> float:
    """Log weight that puts most labelled documents on their side; -``FLOOR`` without wanted ones.

    ``weights`` is what ``weigh`` gives with both tables. Every labelled document counts. The
    places between different weights are compared by running totals over ranges of them.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    marks = marks.where("__id IS NOT NULL AND q IS NOT NULL AND t IS NOT NULL").selectExpr("__id", "q = 1 AND t = 0 AS wanted")
    marked = weights.withColumn("__id", F.col("id").cast("long")).join(marks, "__id")
    steps = marked.groupBy(F.when(F.col("wanted"), F.col("unlabelled")).otherwise(F.col("log_weight")).alias("weight")).agg(
        F.sum(F.when(F.col("wanted"), -1).otherwise(1)).alias("step"), F.count_if("wanted").alias("wanted")
    )
    steps = stage(steps, "floor")
    if not steps.agg(F.sum("wanted")).first()[0]:
        return -FLOOR
    # What is on its side if the floor comes just below a weight, but for a constant.
    totals = running_total(steps, [F.col("weight")], F.col("step"), "through")
    sides = stage(totals.select("weight", (F.col("through") - F.col("step")).alias("right")), "floor")
    most = sides.agg(F.max("right")).first()[0]
    best = sides.where(F.col("right") == most)
    middle = best.count() // 2
    above = assign_row_id(best, [F.col("weight")], "place").where(F.col("place") == middle).first()["weight"]
    below = sides.where(F.col("weight") < above).agg(F.max("weight")).first()[0]
    free(steps, sides)
    return above if below is None else (above + below) / 2


def weigh(
    docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", unlabelled: np.ndarray | None = None
) -> DataFrame:
    """(id, text_key, n_words, log_weight) per document; a second table gives column ``unlabelled``."""
    tables = {"log_weight": ratios} | ({} if unlabelled is None else {"unlabelled": unlabelled})
    shared = docs.sparkSession.sparkContext.broadcast(list(tables.values()))
    names = list(tables)

    def work(batches):
        ratios = shared.value
        telling = np.logical_or.reduce([ratio != 0 for ratio in ratios])
        for batch in batches:
            weights, count = [[] for _ in ratios], []
            for block in words.blocks(batch.column(2)):
                count.append(block.count)
                for parts in _slots(block):
                    found = np.unique(np.concatenate([p[telling[p]] for p in parts]))
                    for ratio, weight in zip(ratios, weights):
                        own = ratio[found]
                        weight.append(float(own[own != 0].sum(dtype=np.float64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.concatenate(count) if count else [], pa.int64()),
                    *[pa.array(weight, pa.float64()) for weight in weights],
                ],
                ["id", "text_key", "n_words", *names],
            )

    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, text_key long, n_words long, {', '.join(f'{n} double' for n in names)}")


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest of a long column, by counts in 4,096 bins that narrow; None if k < 1."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if k < 1 or low is None:
        return None
    while low < high:
        width = max(1, -(-(high - low + 1) // 4096))
        bins = (
            rows.where(F.col(column).between(low, high))
            .groupBy(F.floor((F.col(column) - F.lit(low)) / F.lit(width)).alias("bin"))
            .count()
            .collect()
        )
        for bin_no, n in sorted(((b[0], b[1]) for b in bins), reverse=True):
            if n >= k:
                low = low + bin_no * width
                high = min(high, low + width - 1)
                break
            k -= n
        else:
            return low
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    floor: float | None = None,
    sharpness: float = SHARPNESS,
    seed: int = SEED,
) -> DataFrame:
    """(id, text_key, n_words, log_weight, kept) per document.

    Texts that are null, empty or without n-grams weigh 0, like ordinary text. Equal rows
    have equal keys and share their fate; rows that tie with the k-th all stay. Without
    wanted labels all weights are 0 and all rows stay. Labels that are null or contradict
    each other do not make a document wanted. Other columns are ignored. The floor is
    chosen from the labels unless it is given.
    """
    ratios, unlabelled = fit(docs, labels, id_col, text_col)
    weights = stage(weigh(docs, ratios, id_col, text_col, unlabelled if floor is None else None), "weights")
    if floor is None:
        floor = choose_floor(weights, labels) if ratios.any() else -FLOOR
        sharpness *= FLOOR / max(abs(floor), 1e-3)
    noise = (F.shiftrightunsigned(F.xxhash64("id", "text_key", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    key = F.floor((F.col("log_weight") * sharpness - F.log(-F.log(noise))) * _SCALE)
    rows = weights.drop("unlabelled").withColumn("key", key)
    k = rows.where(F.col("log_weight") >= floor).count()
    least = kth_largest(rows, "key", k)
    kept = F.lit(False) if least is None else F.col("key") >= F.lit(least)
    return rows.withColumn("kept", kept).drop("key").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents that stay, with all their columns."""
    chosen = resample(docs, labels, id_col, text_col, **settings).where("kept")
    chosen = chosen.select(F.col(id_col).alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    rows, at = plain(docs)
    rows = rows.withColumn("key", text_key(at[text_col]))
    same = (F.col("key") == F.col("kept_key")) & F.col(at[id_col]).eqNullSafe(F.col("kept_id"))
    return given_back(rows.join(chosen, same, "left_semi"), docs)
