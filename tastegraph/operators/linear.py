"""Modified-Huber linear classifier by iterated parameter averaging.

Rows are hashed into blocks of bounded size. In every round each block runs a few
local epochs of mini-batch SGD from the current weights; the driver receives only
the size-weighted mean of the block results (one number per feature). Blocks and
their order depend on the row keys alone, so the result does not depend on the
cluster (McDonald, Hall and Mann 2010).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tastegraph import constants as K
from tastegraph.operators.classifiers import TermClassifier

ROWS_PER_BLOCK = 50_000


def huber_gradient(z: np.ndarray) -> np.ndarray:
    """d loss / d z for z = y * f(x): 0 from 1 on, -2(1-z) down to -1, then -4."""
    return np.where(z >= 1.0, 0.0, np.where(z >= -1.0, -2.0 * (1.0 - z), -4.0))


def local_epochs(
    rows: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    weights: np.ndarray,
    epochs: int,
    done: int,
    alpha: float,
    eta0: float,
    batch: int,
) -> np.ndarray:
    """Run SGD over one block. ``weights`` ends with the intercept."""
    offsets, idx, val, y = rows
    w = weights.copy()
    n = len(y)
    per_epoch = math.ceil(n / batch)
    step = done * per_epoch
    for _ in range(epochs):
        for start in range(0, n, batch):
            stop = min(start + batch, n)
            lo, hi = offsets[start], offsets[stop]
            owner = np.repeat(np.arange(stop - start), np.diff(offsets[start : stop + 1]))
            f = np.bincount(owner, val[lo:hi] * w[idx[lo:hi]], minlength=stop - start) + w[-1]
            g = huber_gradient(y[start:stop] * f) * y[start:stop] / (stop - start)
            eta = eta0 / (1.0 + alpha * eta0 * step)
            w[:-1] *= 1.0 - eta * alpha
            w[:-1] -= eta * np.bincount(idx[lo:hi], val[lo:hi] * g[owner], minlength=len(w) - 1)
            w[-1] -= eta * g.sum()
            step += 1
    return w


def fit_modified_huber(
    train: DataFrame,
    size: int,
    key: str = "review_id",
    label: str = "review_score",
    rounds: int = 10,
    epochs: int = K.EPOCHS,
    alpha: float = 1e-4,
    eta0: float = 1.0,
    batch: int = 32,
    name: str = "sgd",
) -> TermClassifier:
    """Fit on ``idx``/``val`` arrays; ``epochs`` in total, spread over ``rounds``."""
    rows = train.select(key, label, "idx", "val")
    blocks = max(1, math.ceil(rows.count() / ROWS_PER_BLOCK))
    order = F.xxhash64(F.lit(K.SPLIT_SEED), F.col(key).cast("string"))
    blocked = rows.select(
        label, "idx", "val", order.alias("place"), F.pmod(order, F.lit(blocks)).alias("block")
    )
    # Kept with its partitioning, so the rounds below do not shuffle again.
    kept = blocked.repartition(blocks, "block").persist(StorageLevel.MEMORY_AND_DISK)
    local = max(1, epochs // rounds)
    weights = np.zeros(size + 1)
    try:
        for number in range(rounds):
            train_block = _block_trainer(weights.copy(), label, local, number * local, alpha, eta0, batch)
            fitted = kept.groupBy("block").applyInArrow(train_block, "n bigint, w array<double>")
            mean = (
                fitted.select("n", F.posexplode("w").alias("i", "w"))
                .groupBy("i")
                .agg((F.sum(F.col("n") * F.col("w")) / F.sum("n")).alias("w"))
            )
            for row in mean.collect():
                weights[row["i"]] = row["w"]
    finally:
        kept.unpersist()
    return TermClassifier(name, float(weights[-1]), tuple(weights[:-1].tolist()), link="huber")


def _block_trainer(weights, label, epochs, done, alpha, eta0, batch):
    """One round's task: local epochs over a block, from the shared weights."""

    def train_block(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        idx, val = table["idx"].combine_chunks(), table["val"].combine_chunks()
        rows = (
            np.concatenate([[0], np.cumsum(idx.value_lengths().to_numpy())]),
            idx.flatten().to_numpy(),
            val.flatten().to_numpy(),
            table[label].to_numpy().astype("float64"),
        )
        fitted = local_epochs(rows, weights, epochs, done, alpha, eta0, batch)
        size = pa.array([table.num_rows], pa.int64())
        return pa.table({"n": size, "w": pa.array([fitted], pa.list_(pa.float64()))})

    return train_block
