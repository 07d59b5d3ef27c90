"""Hard negatives by vertical scans of blocks of vectors (BOND).

Vectors lie in blocks, one column per dimension, with the least and the largest value of
each. For an anchor the columns are read in the order of its magnitudes, largest first.
After each few columns the products so far, plus the least and the most that the columns
not yet read can add, bound every row's score; rows that cannot be among those looked for
leave the block's bitmap, and the columns not yet read are read without them. What is left
has exact scores, since entries are whole numbers.

Two scans per block and group of anchors: the first finds each anchor's positives, the
second the windows of scores that the positives span. A block gives at most ``k`` rows per
anchor, or per window, and Spark merges them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import stage
from tastegraph.llm.whitening import matrix, usable, whole_numbers

#: Entries of a block (16,384 rows of 64) and, about, anchors that meet it at once.
BLOCK_ENTRIES, GROUP_ANCHORS = 1 << 20, 1 << 12
#: Columns that are read between two looks at the bounds.
STEP = 8
#: Scaled entries beyond this count as this; products of 2^11 of them still fit a long.
MOST = 1 << 26


class Columns:
    """A block's columns with their least and largest values, in exact arithmetic."""

    def __init__(self, values: np.ndarray, largest: int):
        """``values`` has a row per dimension; ``largest`` bounds what an anchor's entries are."""
        bound = len(values) * max(1, largest) * max(1, int(np.abs(values).max(initial=0)))
        self.kind = np.float64 if bound < 1 << 53 else np.int64
        self.values = values.astype(self.kind)
        self.low, self.high = self.values.min(axis=1), self.values.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) left of the bitmap ``alive``; ``keep(least, most)`` says which may stay."""
        anchor = anchor.astype(self.kind)
        order = np.argsort(-np.abs(anchor), kind="stable")
        weight = anchor[order]
        ends = np.stack([weight * self.low[order], weight * self.high[order]])
        rest = np.zeros((2, len(order) + 1), self.kind)
        rest[0, :-1] = np.cumsum(ends.min(axis=0)[::-1])[::-1]
        rest[1, :-1] = np.cumsum(ends.max(axis=0)[::-1])[::-1]
        score = np.zeros(len(alive), self.kind)
        for low in range(0, len(order), STEP):
            at = np.flatnonzero(alive)
            known = score[at]
            stay = keep(known + rest[0, low], known + rest[1, low])
            alive[at[~stay]] = False
            at = at[stay]
            if not len(at):
                return at, score[at].astype(np.int64)
            read = order[low : low + STEP]
            score[at] += weight[low : low + STEP] @ self.values[np.ix_(read, at)]
        at = np.flatnonzero(alive)
        at = at[keep(score[at], score[at])]
        return at, score[at].astype(np.int64)


def best(k: int):
    """Rows that may be among the k largest."""

    def keep(least, most):
        if len(least) <= k:
            return np.ones(len(least), bool)
        return most >= np.partition(least, len(least) - k)[-k]

    return keep


def best_of_windows(windows: list[tuple[int, int]], k: int):
    """Rows that may be among the k largest of some window (both ends belong to it)."""

    def keep(least, most):
        out = np.zeros(len(least), bool)
        for low, high in windows:
            may = (most >= low) & (least <= high)
            inside = least[(least >= low) & (most <= high)]
            if len(inside) > k:
                may &= most >= np.partition(inside, len(inside) - k)[-k]
            out |= may
        return out

    return keep


def _vectors(embeddings: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, x) of the rows that take part, one per id."""
    rows = embeddings.where(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        whole_numbers(F.col(vector_col), scale, MOST).alias("x"),
    )
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL")
    return rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("best")).select("id", "best.label", "best.x")


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per block: its number, ids, labels and columns (a row of bytes per dimension)."""

    def packed(parts, number):
        whole = pa.Table.from_batches(parts).combine_chunks()
        lists = whole.column("x").chunk(0)
        dims = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
        columns = np.ascontiguousarray(matrix(lists, dims).T.astype("<i4"))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([dims], pa.int32()),
                pa.array([whole.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([whole.column("label").to_numpy().astype("<i8").tobytes()], pa.binary()),
                pa.array([columns.tobytes()], pa.binary()),
            ],
            ["block", "dims", "ids", "labels", "columns"],
        )

    def work(batches):
        number, held, count, dims = TaskContext.get().partitionId() << 32, [], 0, 1
        for batch in batches:
            dims = max(dims, int(np.diff(batch.column(2).offsets.to_numpy()).max(initial=0)))
            most = max(1, BLOCK_ENTRIES // dims)
            while batch.num_rows:
                part = batch.slice(0, max(1, most - count))
                held.append(part)
                count += part.num_rows
                batch = batch.slice(part.num_rows)
                if count >= most:
                    yield packed(held, number)
                    number, held, count = number + 1, [], 0
        if count:
            yield packed(held, number)

    # Rows of one label lie together, so that blocks have few labels and narrow columns.
    rows = rows.sortWithinPartitions("label", "id")
    return rows.mapInArrow(work, "block long, dims int, ids binary, labels binary, columns binary")


class _Block:
    def __init__(self, table: pa.Table, largest: int):
        self.ids = np.frombuffer(table.column("ids")[0].as_py(), "<i8")
        self.labels = np.frombuffer(table.column("labels")[0].as_py(), "<i8")
        self.dims = table.column("dims")[0].as_py()
        values = np.frombuffer(table.column("columns")[0].as_py(), "<i4").reshape(self.dims, len(self.ids))
        self.columns = Columns(values, largest)


def _anchors(table: pa.Table) -> list[np.ndarray]:
    lists = table.column("x").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _fitted(vector: np.ndarray, dims: int) -> np.ndarray:
    """An anchor with as many entries as a block has columns; missing ones are 0."""
    out = np.zeros(dims, np.int64)
    out[: min(dims, len(vector))] = vector[:dims]
    return out


def _meet(blocks: DataFrame, anchors: DataFrame, groups: int, work, kind: str) -> DataFrame:
    """``work(block table, anchor table)`` for every block and group of anchors.

    The anchors are a stated part of the rows; each group of them goes to each block once.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    left = blocks.withColumn("group", every)
    grid = blocks.select(F.col("block").alias("to_block"), every.alias("of_group"))
    right = anchors.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    right = right.join(grid, F.col("group") == F.col("of_group")).drop("of_group")
    cells = left.groupBy("block", "group").cogroup(right.groupBy("to_block", "group"))
    return cells.applyInArrow(work, kind)


def _positives(k: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            vectors = _anchors(right)
            block = _Block(left, max((int(np.abs(v).max(initial=0)) for v in vectors), default=0))
            of_label = {label: block.labels == label for label in np.unique(block.labels).tolist()}
            for name, label, vector in zip(right.column("id").to_pylist(), right.column("label").to_pylist(), vectors):
                if label not in of_label:
                    continue
                alive = of_label[label] & (block.ids != name)
                rows, scores = block.columns.scan(_fitted(vector, block.dims), alive, best(k))
                first = np.lexsort((block.ids[rows], -scores))[:k]
                out[0] += [name] * len(first)
                out[1] += block.ids[rows[first]].tolist()
                out[2] += scores[first].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], ["id", "positive_id", "positive_score"])

    return work


def _negatives(k: int, percent: int):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            vectors = _anchors(right)
            block = _Block(left, max((int(np.abs(v).max(initial=0)) for v in vectors), default=0))
            other = {label: block.labels != label for label in set(right.column("label").to_pylist())}
            for name, label, found, vector in zip(
                right.column("id").to_pylist(), right.column("label").to_pylist(), right.column("positives").to_pylist(), vectors
            ):
                windows = [(-(-percent * p["positive_score"] // 100), p["positive_score"]) for p in found]
                rows, scores = block.columns.scan(_fitted(vector, block.dims), other[label].copy(), best_of_windows(windows, k))
                order = np.lexsort((block.ids[rows], -scores))
                rows, scores = block.ids[rows[order]], scores[order]
                for positive, (low, high) in zip(found, windows):
                    first = np.flatnonzero((scores >= low) & (scores <= high))[:k]
                    out[0] += [name] * len(first)
                    out[1] += [positive["positive_id"]] * len(first)
                    out[2] += [high] * len(first)
                    out[3] += rows[first].tolist()
                    out[4] += scores[first].tolist()
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(c, pa.int64()) for c in out], names)

    return work


def mine(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Entries become ``floor(scale * entry)`` (2^26 at most, without sign), scores are inner
    products, larger ones first, equal ones by smaller id. Rows whose id is divisible by
    ``every`` are anchors, searched against all rows. An anchor's positives are the first
    rows of its label, its negatives per positive the first rows of other labels with
    ``percent * positive_score <= 100 * negative_score <= 100 * positive_score``.

    Rows without an id, a label or a vector, or with a null or non-finite entry, take no
    part. Labels and ids are whole numbers. Of several rows with one id the one with the
    smallest label, then vector, takes part. Missing entries of a shorter vector are 0. An
    anchor without positives, and a positive without negatives, give no rows. An empty
    table gives none. Other columns are ignored.
    """
    label = F.col(label) if isinstance(label, str) else label
    blocks = stage(_blocks(_vectors(embeddings, id_col, vector_col, label, scale)), "blocks")

    def unpacked(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
                chosen = np.flatnonzero(ids % every == 0)
                if len(chosen):
                    columns = np.frombuffer(batch.column(3)[i].as_py(), "<i4").reshape(batch.column(0)[i].as_py(), len(ids))
                    labels = np.frombuffer(batch.column(2)[i].as_py(), "<i8")
                    offsets = np.arange(len(chosen) + 1, dtype=np.int32) * len(columns)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(columns[:, chosen].T.ravel().astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[chosen]), pa.array(labels[chosen]), lists], ["id", "label", "x"])

    packed = blocks.select("dims", "ids", "labels", "columns")
    anchors = stage(packed.mapInArrow(unpacked, "id long, label long, x array<long>"), "anchors")
    groups = max(1, -(-anchors.count() // GROUP_ANCHORS))

    near = _meet(blocks, anchors, groups, _positives(positives), "id long, positive_id long, positive_score long")
    first = Window.partitionBy("id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    near = near.groupBy("id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    known = stage(anchors.join(near, "id"), "positives")

    kind = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    far = _meet(blocks, known, groups, _negatives(negatives, percent), kind)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
