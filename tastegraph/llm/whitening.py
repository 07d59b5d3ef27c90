"""Whitening of embeddings from exact, bit-sliced cross-products.

Entries become whole numbers. In every task the numbers of a dimension, shifted by the
least of a block of rows, are cut into bit planes, and each plane is packed across rows
into 64-bit words. A cross-product of two dimensions is then a sum over pairs of planes:
two to the power of both bits times the popcount of the planes' AND. Tasks sum them as
whole numbers, Spark adds the tasks' sums as decimals, and the driver gets one number per
pair of dimensions, which the width of a vector bounds. They are centred as whole numbers,
``n * sum(xy) - sum(x) * sum(y)``, before the only rounding, and go to ``eigh``.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose planes are packed together.
BLOCK_ROWS = 1 << 16
#: Words of a plane that are counted together, so that a slice of all planes stays in cache.
SLICE_WORDS = 128
#: Bits whose weights are summed in one long: 2 * LIMB + log2(BLOCK_ROWS) stay below 63.
LIMB = 16
#: Scaled entries beyond this count as this.
MOST = 1 << 46


def usable(vector: Column) -> Column:
    """False for null vectors and those with null or non-finite entries."""
    wrong = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~wrong, F.lit(False))


def whole_numbers(vector: Column, scale: int, most: int) -> Column:
    """``floor(scale * entry)`` of every entry, taken as double, held within -most and most."""

    def number(c):
        scaled = F.floor(c.cast("double") * scale) if scale != 1 else F.floor(c.cast("double"))
        far = c.cast("double") * scale
        return F.when(far >= most, F.lit(most)).when(far <= -most, F.lit(-most)).otherwise(scaled).cast("long")

    return F.transform(vector, number)


def matrix(column: pa.Array, dims: int, absent: int = 0) -> np.ndarray:
    """A list column as rows of a matrix; entries beyond a shorter list are ``absent``."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == dims).all():
        return values.reshape(len(column), dims)
    out = np.full((len(column), dims), absent, np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = values
    return out


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension, bit): the set bits of non-negative numbers, packed across rows."""
    planes, owner, bits = [], [], []
    for dim, top in enumerate(shifted.max(axis=0)):
        for bit in range(int(top).bit_length()):
            packed = np.packbits(((shifted[:, dim] >> bit) & 1).astype(bool))
            planes.append(np.pad(packed, (0, -len(packed) % 8)).view(np.uint64))
            owner.append(dim)
            bits.append(bit)
    words = -(-len(shifted) // 64)
    return np.array(planes, np.uint64).reshape(len(owner), words), np.array(owner, int), np.array(bits, int)


def shared_counts(planes: np.ndarray) -> np.ndarray:
    """How many rows have the bits of both planes set, for every pair of planes."""
    out = np.zeros((len(planes), len(planes)), np.int64)
    for low in range(0, planes.shape[1], SLICE_WORDS):
        part = np.ascontiguousarray(planes[:, low : low + SLICE_WORDS])
        for a in range(len(part)):
            out[a, a:] += np.bitwise_count(part[a:] & part[a]).sum(axis=1, dtype=np.int64)
    return out + np.triu(out, 1).T


def cross_products(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (sums, sums of products) of the columns of whole numbers, as Python integers."""
    rows, dims = block.shape
    least = block.min(axis=0)
    planes, owner, bits = bit_planes(block - least)
    counts = shared_counts(planes)
    limbs = range(-(-int(bits.max(initial=0) + 1) // LIMB))
    weights = []
    for limb in limbs:
        weight = np.zeros((dims, len(owner)), np.int64)
        at = np.flatnonzero(bits // LIMB == limb)
        weight[owner[at], at] = 1 << (bits[at] % LIMB)
        weights.append(weight)
    product, total = np.zeros((dims, dims), object), np.zeros(dims, object)
    for i, left in enumerate(weights):
        total += (left @ np.diag(counts)).astype(object) * (1 << LIMB * i)
        for j, right in enumerate(weights):
            product += (left @ counts @ right.T).astype(object) * (1 << LIMB * (i + j))
    least = least.astype(object)
    product += np.outer(least, total) + np.outer(total, least) + rows * np.outer(least, least)
    return total + rows * least, product


def _blocks(batches, dims: int, absent: int):
    """Matrices of at most BLOCK_ROWS rows of a task's batches (x is the last column)."""
    held, rows = [], 0
    for batch in batches:
        values = matrix(batch.column(batch.num_columns - 1), dims, absent)
        while rows + len(values) >= BLOCK_ROWS:
            held.append(values[: BLOCK_ROWS - rows])
            values, rows = values[BLOCK_ROWS - rows :], 0
            yield np.concatenate(held)
            held = []
        if len(values):
            held.append(values)
            rows += len(values)
    if rows:
        yield np.concatenate(held)


def _summed(rows: DataFrame, dims: int, absent: int) -> tuple[list[int], list[list[int]]]:
    """Sums (S) and sums of products over all rows, as Python integers."""

    def work(batches):
        sums, products = np.zeros(dims, object), np.zeros((dims, dims), object)
        some = False
        for block in _blocks(batches, dims, absent):
            total, product = cross_products(block)
            sums, products, some = sums + total, products + product, True
        if some:
            first = [*range(dims), *np.repeat(np.arange(dims), np.arange(dims, 0, -1)).tolist()]
            second = [*([-1] * dims), *(j for i in range(dims) for j in range(i, dims))]
            values = [*sums, *(products[i, j] for i in range(dims) for j in range(i, dims))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))],
                ["i", "j", "value"],
            )

    parts = rows.select("x").mapInArrow(work, "i int, j int, value decimal(38,0)")
    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    for row in parts.groupBy("i", "j").agg(F.sum("value").cast("decimal(38,0)").alias("value")).toLocalIterator():
        if row["j"] < 0:
            sums[row["i"]] = int(row["value"])
        else:
            products[row["i"]][row["j"]] = products[row["j"]][row["i"]] = int(row["value"])
    return sums, products


def components_of(n: int, sums: list[int], products: list[list[int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors as columns, trace), largest first.

    The covariance is centred in whole numbers and each entry is rounded once. The entry of
    a vector that is largest without its sign is positive.
    """
    dims = len(sums)
    covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(covariance.reshape(dims, dims))
    values, vectors = values[::-1], vectors[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)]) if dims else 1
    return values, vectors * sign, float(np.trace(covariance.reshape(dims, dims)))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, list]:
    """``n * x - S`` as doubles of exact numbers, and the exact sum of its squares per row.

    Squares are summed modulo 2^64, which is exact as long as the sum fits a long; a sum
    that does not is None.
    """
    far = np.maximum(np.abs(x).max(axis=0, initial=0).astype(object) * n + np.abs(sums), 0)
    if all(v < 1 << 62 for v in far):
        centred = x * np.int64(n) - sums.astype(np.int64)
    else:
        centred = x.astype(object) * n - sums
    whole = centred.astype(np.float64)
    about = (whole**2).sum(axis=1)
    if centred.dtype == object:
        exact = [int(v) for v in (centred**2).sum(axis=1)]
    else:
        exact = (centred * centred).sum(axis=1).tolist()
        for row in np.flatnonzero(about > 2.0**62):
            exact[row] = sum(int(v) ** 2 for v in centred[row])
    return whole, [v if v < 1 << 63 else None for v in exact]


def whiten(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    offset: int = 1_000_000,
    most_components: int = 32,
) -> DataFrame:
    """One row per remaining vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Null vectors and those with null or non-finite entries are dropped. The others become
    ``x = floor(scale * entry) + offset`` and are all of the fit list, repeated rows and rows
    with equal or null ids as often as they are there. Entries of 2^46 / scale and more count
    as that. A vector shorter than the longest has 0 in its missing entries. ``component``
    counts from 1 by falling eigenvalue; equal eigenvalues keep the order ``eigh`` gives
    them. ``deviation`` is null if it does not fit a long. A component without variance (an
    eigenvalue of 1e-12 of the largest, or less) has no whitened value: it is null, and does
    not count in ``identity_error``, which is measured on the whitened rows. An empty table
    gives no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    vector = F.col(vector_col)
    kept = embeddings.where(usable(vector))
    x = F.transform(whole_numbers(vector, scale, MOST), lambda c: c + F.lit(offset).cast("long"))
    rows = kept.select(F.col(id_col).alias("id"), x.alias("x"))
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims")).first()
    n, dims = shape["n"], shape["dims"] or 0
    kind = f"{id_col} {embeddings.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double"
    if not n or not dims:
        return spark.createDataFrame([], kind + ", identity_error double")
    sums, products = _summed(rows, dims, offset)
    values, vectors, trace = components_of(n, sums, products)
    count = min(most_components, dims)
    varies = values[:count] > max(values[0], 0.0) * 1e-12
    turn = vectors[:, :count] / np.sqrt(np.where(varies, values[:count], 1.0))
    explained = np.maximum(values[:count], 0.0) / trace if trace > 0 else np.zeros(count)
    whole_sums = np.array(sums, object)

    def projected(batch):
        centred, exact = deviations(matrix(batch.column(batch.num_columns - 1), dims, offset), n, whole_sums)
        return (centred / n) @ turn, exact

    def products_of(batches):
        total = np.zeros((count, count))
        for batch in batches:
            white = projected(batch)[0]
            total += white.T @ white
        i, j = np.triu_indices(count)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"])

    found = rows.select("x").mapInArrow(products_of, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("v"))
    error = 0.0
    for row in found.toLocalIterator():
        if varies[row["i"]] and varies[row["j"]]:
            error = max(error, abs(row["v"] / n - (row["i"] == row["j"])))

    def work(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1 << 12):
                part = batch.slice(low, 1 << 12)
                white, exact = projected(part)
                m = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(m), count))),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * count, n, np.int64)),
                        pa.array([v for v in exact for _ in range(count)], pa.int64()),
                        pa.array(white.ravel(), mask=np.tile(~varies, m)),
                        pa.array(np.tile(explained, m)),
                    ],
                    [id_col, "component", "n", "deviation", "whitened", "explained"],
                )

    return rows.mapInArrow(work, kind).withColumn("identity_error", F.lit(float(error)))
