"""Quality rules: fixed base rules, then a calibrated classifier on hashed n-grams.

The classifier is a logistic regression on the presence of hashed words, byte trigrams
and shares of repeated words. It is trained on at most ``MOST_ROWS`` labelled documents
(those with the smallest hash of their id), by gradient steps on the driver; one part of
the sample is held back to calibrate the probability (Platt scaling). All documents are
scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import text_key

#: Labelled documents that training uses at most.
MOST_ROWS = 12_000
WORD_BITS, CHAR_BITS = 17, 16
REPEATS = (1 / 8, 1 / 4, 1 / 2)
SLOTS = (1 << WORD_BITS) + (1 << CHAR_BITS) + len(REPEATS)
LEAST_PROBABILITY = 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST_DOCUMENTS = 20
STEPS, RATE, SHRINK, SEED = 150, 1.0, 1e-6, 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def base_counts(block: words.Block, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a block's rows."""
    data, edges = block.data, block.edges

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[edges[1:]] - total[edges[:-1]]

    inside = ~words.SPACE[data]
    starts_char = (data & 0xC0) != 0x80  # not a continuation byte
    out = {
        "n_words": block.count.astype(np.int64),
        "word_chars": per_row(inside & starts_char),
        "n_symbols": per_row(_SYMBOLS[data]),
    }
    duplicates, repeated = np.zeros(block.rows, np.int64), np.zeros(block.rows, np.int64)
    for row in range(block.rows):
        lines = [line for line in block.text(row).split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
        duplicates[row] = len(lines) - len(set(lines))
        part = hashes[block.first[row] : block.first[row] + block.count[row]]
        three = words.grams(part, 3)
        if len(three) > 1:
            order = np.argsort(three, kind="stable")
            same = three[order][1:] == three[order][:-1]
            twice = np.zeros(len(three), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(len(part), bool)
            for i in range(3):
                covered[i : i + len(three)] |= twice
            repeated[row] = np.count_nonzero(covered)
    return out | {"n_dup_lines": duplicates, "n_repeat_words": repeated}


def features(block: words.Block, hashes: np.ndarray):
    """Per row of the block the sorted distinct slots of its n-grams."""
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    data = block.data.astype(np.uint32)
    three = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
    three = ((three * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)).astype(np.int32) + (1 << WORD_BITS)
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    for row in range(block.rows):
        first, count = block.first[row], block.count[row]
        begin, end = block.edges[row], max(block.edges[row], block.edges[row + 1] - 2)
        repeats = np.count_nonzero(again[first + 1 : first + count])
        share = [SLOTS - len(REPEATS) + i for i, s in enumerate(REPEATS) if repeats and repeats >= s * (count - 1)]
        yield np.unique(np.concatenate([word[first : first + count], three[begin:end], np.array(share, np.int32)]))


def _scores(flat: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean-free sums of the weights of each row's slots."""
    total = np.concatenate([[0.0], np.cumsum(weights[flat], dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


class Model:
    """Weights per slot, intercept, and the slope and intercept of the calibration."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def probability(self, slots: np.ndarray) -> float:
        raw = float(self.weights[slots].sum(dtype=np.float64)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(rows: list[np.ndarray], good: np.ndarray, chosen: np.ndarray) -> Model:
    """Fit on the rows ``chosen``, calibrate on the others.

    Steps are scaled per slot by the root of summed squared gradients. Without both kinds
    of labels the model says the share of good ones.
    """
    weights = np.zeros(SLOTS, np.float32)
    if not len(good) or good.all() or not good.any():
        share = 0.5 if not len(good) else float(np.clip(good.mean(), 1e-3, 1 - 1e-3))
        return Model(weights, float(np.log(share / (1 - share))), 1.0, 0.0)
    flat = np.concatenate([rows[i] for i in np.flatnonzero(chosen)])
    lengths = np.array([len(rows[i]) for i in np.flatnonzero(chosen)])
    bounds, owner = np.concatenate([[0], np.cumsum(lengths)]), np.repeat(np.arange(len(lengths)), lengths)
    y = good[chosen].astype(np.float64)
    # N-grams of a few documents say nothing about others.
    common = np.bincount(flat, minlength=SLOTS) >= LEAST_DOCUMENTS
    bias, squares, bias_squares = 0.0, np.full(SLOTS, 1e-8), 1e-8
    for _ in range(STEPS):
        error = (_sigmoid(_scores(flat, bounds, weights) + bias) - y) / len(y)
        slope = np.bincount(flat, weights=error[owner], minlength=SLOTS) + SHRINK * weights
        squares += slope**2
        weights -= (RATE / 10 * common * slope / np.sqrt(squares)).astype(np.float32)
        bias_squares += error.sum() ** 2
        bias -= RATE / 10 * error.sum() / np.sqrt(bias_squares)
    rest = np.flatnonzero(~chosen)
    raw = np.array([weights[rows[i]].sum(dtype=np.float64) + bias for i in rest])
    y = good[rest].astype(np.float64)
    if not len(y) or y.all() or not y.any():
        return Model(weights, bias, 1.0, 0.0)
    # Platt: targets drawn in by the counts, Newton steps on slope and intercept.
    scale = max(1e-9, float(np.abs(raw).mean()))
    x, (a, b) = raw / scale, (1.0, 0.0)
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(50):
        p = _sigmoid(a * x + b)
        w = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((p - goal) * x).sum() + 1e-3 * a, (p - goal).sum()])
        curve = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(curve, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Model(weights, bias, a / scale, b)


def labelled_sample(labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, good) of at most ``most`` documents; good has quality 1 and is not toxic."""
    rows = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")
    )
    rows = rows.where("doc_id IS NOT NULL AND q IS NOT NULL")
    rows = rows.select("doc_id", F.expr("q = 1 AND t = 0").alias("good"))
    order = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    count = rows.count()
    if count > most:
        # Only about twice the wanted rows reach the ordering.
        rows = rows.where(order < int((1 << 30) * min(1.0, 2 * most / count)))
    return rows.orderBy(order, "doc_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on labelled documents; the sample's features are what reaches the driver."""
    spark = docs.sparkSession
    sample = labelled_sample(labels).toArrow()
    order = np.argsort(sample["doc_id"].to_numpy())
    shared = spark.sparkContext.broadcast(
        (sample["doc_id"].to_numpy()[order], sample["good"].to_numpy(zero_copy_only=False)[order])
    )

    def work(batches):
        ids, good = shared.value
        for batch in batches:
            own = batch.column(0).fill_null(-1).to_numpy()
            at = np.minimum(np.searchsorted(ids, own), max(0, len(ids) - 1))
            hit = np.flatnonzero((ids[at] == own) & batch.column(0).is_valid().to_numpy(False)) if len(ids) else []
            taken = batch.take(pa.array(hit, pa.int64()))
            found = []
            for block in words.blocks(taken.column(1)):
                found.extend(features(block, block.hashes()))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), pa.array(good[at[hit]] if len(found) else [], pa.bool_()), pa.array(found, pa.list_(pa.int32()))],
                ["id", "good", "slots"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = rows.mapInArrow(work, "id long, good boolean, slots array<int>").dropDuplicates(["id"]).toArrow()
    shared.destroy()
    table = table.sort_by("id")
    slots = [np.asarray(s.values) for s in table["slots"].combine_chunks()] if len(table) else []
    good = table["good"].to_numpy(zero_copy_only=False).astype(bool)
    # Every fourth document is held back for the calibration.
    return train(slots, good, np.arange(len(good)) % 4 != 3)


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_probability: float = LEAST_PROBABILITY,
) -> DataFrame:
    """Base counts, base_failed, probability and kept per document.

    Null and empty texts have no words and fail the base rules. Repeated rows are scored
    each. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batches):
        known = shared.value
        for batch in batches:
            counts, probability = {n: [] for n in names}, []
            for block in words.blocks(batch.column(2)):
                hashes = block.hashes()
                for name, values in base_counts(block, hashes).items():
                    counts[name].append(values)
                probability.extend(known.probability(s) for s in features(block, hashes))
            columns = [pa.array(np.concatenate(counts[n]) if counts[n] else [], pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns, pa.array(probability, pa.float64())],
                ["id", "text_key", *names, "probability"],
            )

    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    out = rows.mapInArrow(work, f"id {kind}, text_key long, {', '.join(f'{n} long' for n in names)}, probability double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least_probability))
    return out.withColumnRenamed("id", id_col)
