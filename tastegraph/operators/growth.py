"""A binary decision tree grown on sparse rows, with the splits that MLlib's would take.

A feature has at most ``BINS`` bins, whose borders follow from the values of all training rows.
A row is stored as its cells, the (feature, bin) pairs outside of the feature's bin of zero, so
the work is in proportion to the terms of the rows, not to the vocabulary. While the rows of an
open node have more than ``ALONE`` cells, its classes are counted per cell side by side: a pass
serves all such nodes of a level (in groups of ``TOGETHER``), and one row per node and few
features is dealt. A smaller node's rows are then dealt once, and one task grows all that is
below it. Nodes with more than ``ALONE`` cells are at most all cells divided by it, so the
number of passes does not follow the size of the tree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.session import free, stage

BINS = 32
#: Cells of a node that one task takes alone, nodes that are counted in one pass.
ALONE, TOGETHER = 1 << 22, 16
#: Values that are sorted and cells that are counted at once, rows that are walked at once.
HELD, ROWS = 1 << 21, 1 << 10
#: Values, and features, of a dealt row.
VALUES, FEATURES = 512, 8
#: Children purer than this are not split.
EPSILON = np.finfo(float).eps


@dataclass
class Nodes:
    """Nodes by number: a leaf has feature -1, ``bin`` is the last one that goes to the left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    counts: list[tuple[int, int]] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, counts: tuple[int, int], depth: int) -> int:
        self.feature.append(-1)
        self.bin.append(-1)
        self.left.append(-1)
        self.right.append(-1)
        self.counts.append(counts)
        self.depth.append(depth)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, last: int, left: tuple[int, int]) -> tuple[int, int]:
        whole, depth = self.counts[node], self.depth[node] + 1
        self.feature[node], self.bin[node] = feature, last
        self.left[node] = self.add(left, depth)
        self.right[node] = self.add((whole[0] - left[0], whole[1] - left[1]), depth)
        return self.left[node], self.right[node]

    def ends(self, node: int, max_depth: int) -> bool:
        """Whether a child is a leaf before it is looked at."""
        a, b = (np.float64(c) for c in self.counts[node])
        return self.depth[node] >= max_depth or abs(gini(a, b, a + b)) < EPSILON

    def pruned(self) -> Nodes:
        """From the root, a node before its left and then its right subtree; two leaves of one class become one."""
        leaf, guess = [True] * len(self.feature), [b > a for a, b in self.counts]
        for node in reversed(range(len(self.feature))):  # a child has a larger number
            if self.feature[node] >= 0:
                low, high = self.left[node], self.right[node]
                leaf[node] = leaf[low] and leaf[high] and guess[low] == guess[high]
        out, todo = Nodes(), [(0, None, None)]
        while todo:
            node, parent, side = todo.pop()
            at = out.add(self.counts[node], self.depth[node])
            if parent is not None:
                side[parent] = at
            if not leaf[node]:
                out.feature[at], out.bin[at] = self.feature[node], self.bin[node]
                todo += [(self.right[node], at, out.right), (self.left[node], at, out.left)]
        return out


def gini(a: np.ndarray, b: np.ndarray, total: np.ndarray) -> np.ndarray:
    return 1.0 - (a / total) * (a / total) - (b / total) * (b / total)


def best_split(counts: np.ndarray, cuts: np.ndarray) -> tuple[float, int, int]:
    """(gain, place, bin) of the best split; of equal ones the first feature's and bin's.

    ``counts`` holds classes per feature and bin, ``cuts`` how many splits each feature has.
    """
    counts = counts.astype(float)
    whole = counts.sum(axis=1)
    a, b = counts[:, :-1, 0].cumsum(axis=1), counts[:, :-1, 1].cumsum(axis=1)
    left, total = a + b, whole.sum(axis=1, keepdims=True)
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        sides = (left / total) * gini(a, b, left), (right / total) * gini(whole[:, :1] - a, whole[:, 1:] - b, right)
        gain = gini(whole[:, :1], whole[:, 1:], total) - sides[0] - sides[1]
    none = (left < 1) | (right < 1) | (np.arange(gain.shape[1]) >= cuts[:, None])
    gain[none] = -np.inf
    place, last = divmod(int(np.argmax(gain)), gain.shape[1])
    return float(gain[place, last]), place, last


def cut_points(values: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """Borders between the values of a feature; the rows without one have 0.

    With few values every middle of neighbours is a border, else those next to the multiples of
    ``rows / bins`` in the order of the values.
    """
    found, counts = np.unique(values, return_counts=True)
    if rows > len(values):
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, rows - len(values))
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle
    so_far = np.cumsum(counts).astype(float)
    closer = (so_far[:-1] + so_far[1:]) / 2
    stride, out, at = rows / bins, [], 0
    while True:
        at = max(at, int(np.searchsorted(closer, stride * (len(out) + 1), side="right")))
        if at >= len(middle):
            return middle[out]
        out.append(at)
        at += 1


def _runs(batches):
    """(key, parts) per run of rows with an equal first column, across batches."""
    held, last = [], None
    for batch in batches:
        names = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)] if len(names) else [0]
        for low, high in zip(edges[:-1], edges[1:]):
            if held and names[low] != last:
                yield last, held
                held = []
            held.append(batch.slice(low, high - low))
            last = names[low]
    if held:
        yield last, held


def _pieces(batches):
    """The batches in slices of few rows, so that what a task builds at once stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def _lists(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """The items of a list column and how many each row has; a missing list has none."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def _cuts(rows: DataFrame, size: int, count: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(borders per feature, filled up with infinity; how many there are), from all rows."""

    def sorted_lists(parts):
        feature, value = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((value, feature))
        feature, value = feature[order], value[order]
        first = np.flatnonzero(np.diff(feature, prepend=-1))
        many = np.diff(first, append=len(feature))
        pieces = -(-many // VALUES)
        inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(first, pieces) + VALUES * inside
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(value)), pa.int32()), pa.array(value))
        return pa.RecordBatch.from_arrays([pa.array(feature[starts], pa.int32()), lists], ["feature", "value"])

    def deal(batches):
        parts, held = [], 0
        for batch in batches:
            (feature, _), (value, _) = _lists(batch, 1), _lists(batch, 2)
            some = value != 0
            if some.any():
                parts.append((feature[some], value[some]))
                held += len(parts[-1][0])
            if held >= HELD:
                yield sorted_lists(parts)
                parts, held = [], 0
        if held:
            yield sorted_lists(parts)

    def cut(batches):
        for feature, parts in _runs(batches):
            found = cut_points(np.concatenate([p.column(1).flatten().to_numpy() for p in parts]), count, bins)
            yield pa.RecordBatch.from_arrays([pa.array([feature], pa.int32()), pa.array([found], pa.list_(pa.float64()))], ["feature", "cuts"])

    dealt = rows.mapInArrow(deal, "feature int, value array<double>").repartition("feature").sortWithinPartitions("feature")
    out, many = np.full((size, BINS), np.inf), np.zeros(size, int)
    for row in dealt.mapInArrow(cut, "feature int, cuts array<double>").collect():
        many[row["feature"]] = len(row["cuts"])
        out[row["feature"], : len(row["cuts"])] = row["cuts"]
    return out, many


def _cells(rows: DataFrame, cuts: np.ndarray, zero: np.ndarray) -> DataFrame:
    """(label, cells): ``feature * BINS + bin`` of the values outside of the bin of zero."""

    def work(batches):
        for batch in _pieces(batches):
            (feature, n), (value, _) = _lists(batch, 1), _lists(batch, 2)
            at = np.zeros(len(value), np.int32)
            for step in (16, 8, 4, 2, 1):  # how many borders are below the value
                at += step * (cuts[feature, at + step - 1] < value)
            some = at != zero[feature]
            owner = np.repeat(np.arange(len(n)), n)[some]
            cells = (feature[some].astype(np.int64) * BINS + at[some]).astype(np.int32)
            order = np.lexsort((cells, owner))
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells[order]))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["label", "cells"])

    return rows.mapInArrow(work, "label int, cells array<int>")


def _reached(nodes: Nodes, size: int, zero: np.ndarray):
    """A function from the cells of rows to the node of each row."""
    feature, last, left, right = (np.array(x) for x in (nodes.feature, nodes.bin, nodes.left, nodes.right))
    width = size * BINS

    def walk(cells: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        keys = owner * width + cells  # in order
        at, moving = np.zeros(n, int), np.arange(n if feature[0] >= 0 else 0)
        while len(moving):
            node = at[moving]
            asked = moving * width + feature[node] * BINS
            place = np.searchsorted(keys, asked)
            found = keys[np.minimum(place, len(keys) - 1)] - asked if len(keys) else np.full(len(moving), -1)
            known = (place < len(keys)) & (found >= 0) & (found < BINS)
            low = np.where(known, found, zero[feature[node]]) <= last[node]
            at[moving] = np.where(low, left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at

    return walk


def _counted(rows: DataFrame, nodes: Nodes, group: list[int], cells_of: dict[int, int], many: np.ndarray, zero: np.ndarray):
    """Best split of each node of a group: node to (gain, feature, bin, left counts, left cells)."""
    size, walk = len(zero), _reached(nodes, len(zero), zero)
    place = np.full(len(nodes.feature), -1)
    place[group] = np.arange(len(group))
    whole = np.array([[*nodes.counts[g], cells_of[g]] for g in group], float)
    blocks = -(-size // FEATURES)

    def count(batches):
        width = blocks * FEATURES * BINS
        total, parts, held = np.zeros((len(group) * width, 3), np.int64), [], 0

        def add():
            key, weight = (np.concatenate(c) for c in zip(*parts))
            total[:, :2] += np.bincount(key, minlength=2 * len(total)).reshape(-1, 2)
            total[:, 2] += np.bincount(key >> 1, weight, minlength=len(total)).astype(np.int64)
            parts.clear()

        for batch in _pieces(batches):
            cells, n = _lists(batch, 1)
            owner = np.repeat(np.arange(len(n)), n)
            slot = place[walk(cells, owner, len(n))]
            some = slot[owner] >= 0
            owner, cells = owner[some], cells[some]
            if len(cells):
                label = batch.column(0).to_numpy()
                parts.append((((slot[owner] * width + cells) << 1) + label[owner], n[owner]))
                held += len(cells)
            if held >= HELD:
                add()
                held = 0
        if parts:
            add()
        total = total.reshape(len(group), blocks, -1)
        some = np.argwhere(total.any(axis=2))
        for low in range(0, len(some), 4096):
            at = some[low : low + 4096]
            data = [x.tobytes() for x in total[at[:, 0], at[:, 1]]]
            keys = pa.array((at[:, 0] * blocks + at[:, 1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([keys, pa.array(data, pa.binary())], ["at", "total"])

    def choose(batches):
        for key, parts in _runs(batches):
            slot, block = divmod(int(key), blocks)
            total = sum(np.frombuffer(x.as_py(), np.int64) for p in parts for x in p.column(1))
            total = total.reshape(FEATURES, BINS, 3).astype(float)
            features = np.arange(block * FEATURES, min((block + 1) * FEATURES, size))
            total = total[: len(features)]
            total[np.arange(len(features)), zero[features]] = whole[slot] - total.sum(axis=1)
            gain, at, last = best_split(total[:, :, :2], many[features])
            if gain > 0:
                left = total[at, : last + 1].sum(axis=0).astype(int).tolist()
                yield pa.RecordBatch.from_pylist([dict(zip(SPLIT, (slot, gain, int(features[at]), last, *left)))], schema=SPLIT_ARROW)

    dealt = rows.mapInArrow(count, "at int, total binary").repartition("at").sortWithinPartitions("at")
    best = {}
    for r in dealt.mapInArrow(choose, SPLIT_SCHEMA).collect():
        rank = (-r["gain"], r["feature"], r["bin"])
        if r["slot"] not in best or rank < best[r["slot"]][0]:
            best[r["slot"]] = rank, (r["gain"], r["feature"], r["bin"], (r["a"], r["b"]), r["cells"])
    return {group[slot]: found for slot, (_, found) in best.items()}


SPLIT = ("slot", "gain", "feature", "bin", "a", "b", "cells")
SPLIT_SCHEMA = "slot int, gain double, feature int, bin int, a long, b long, cells long"
SPLIT_ARROW = pa.schema([(n, {"gain": pa.float64(), "a": pa.int64(), "b": pa.int64(), "cells": pa.int64()}.get(n, pa.int32())) for n in SPLIT])


def grow_alone(label: np.ndarray, cells: np.ndarray, n: np.ndarray, many: np.ndarray, zero: np.ndarray, depth: int, max_depth: int) -> Nodes:
    """The whole subtree of a node at ``depth``, from all of its rows."""
    ones = int(label.sum())
    nodes = Nodes()
    nodes.add((len(label) - ones, ones), depth)
    todo = [(0, label.astype(np.int8), cells, np.repeat(np.arange(len(n), dtype=np.int32), n))]
    while todo:
        node, label, cells, owner = todo.pop()
        there = np.zeros(len(zero), bool)
        there[cells // BINS] = True
        features = np.flatnonzero(there & (many > 0))
        if not len(features):
            continue
        places = np.zeros(len(zero), np.int64)
        places[features] = np.arange(len(features))
        key = ((places[cells // BINS] * BINS + cells % BINS) << 1) + label[owner]
        counts = np.bincount(key, minlength=len(features) * BINS * 2).reshape(len(features), BINS, 2)
        counts[np.arange(len(features)), zero[features]] = np.array(nodes.counts[node]) - counts.sum(axis=1)
        gain, at, last = best_split(counts, many[features])
        if gain <= 0:
            continue
        feature = int(features[at])
        left = counts[at, : last + 1].sum(axis=0).tolist()
        children = nodes.split(node, feature, last, tuple(left))
        low = np.full(len(label), zero[feature] <= last)
        own = cells // BINS == feature
        low[owner[own]] = cells[own] % BINS <= last
        for child, here in zip(children, (low, ~low)):
            if not nodes.ends(child, max_depth):
                kept = here[owner]
                renamed = np.cumsum(here, dtype=np.int32) - 1
                todo.append((child, label[here], cells[kept], renamed[owner[kept]]))
    return nodes


def _grown_below(rows: DataFrame, nodes: Nodes, small: dict[int, int], many: np.ndarray, zero: np.ndarray, max_depth: int) -> dict[int, Nodes]:
    """The subtrees of small nodes, each grown by one task; tasks get nearly the same cells."""
    walk, depths = _reached(nodes, len(zero), zero), list(nodes.depth)
    parts = min(len(small), max(64, -(-sum(small.values()) // ALONE)))
    load, part = np.zeros(parts), np.full(len(nodes.feature), -1)
    for node in sorted(small, key=lambda x: (-small[x], x)):
        part[node] = int(np.argmin(load))
        load[part[node]] += small[node] + 1

    def place(batches):
        for batch in _pieces(batches):
            cells, n = _lists(batch, 1)
            at = walk(cells, np.repeat(np.arange(len(n)), n), len(n))
            batch = pa.RecordBatch.from_arrays(
                [pa.array(part[at], pa.int32()), pa.array(at, pa.int32()), *batch.columns], ["part", "node", "label", "cells"]
            )
            yield batch.filter(pc.greater_equal(batch.column(0), 0))

    def grow(batches):
        for node, held in _runs(batches):
            label = np.concatenate([p.column(1).to_numpy() for p in held])
            cells, n = (np.concatenate(c) for c in zip(*[_lists(p, 2) for p in held]))
            held.clear()
            found = grow_alone(label, cells, n, many, zero, depths[node], max_depth).pruned()
            size = len(found.feature)
            a, b = zip(*found.counts)
            columns = [np.full(size, node), np.arange(size), found.feature, found.bin, found.left, found.right]
            columns = [pa.array(c, pa.int32()) for c in columns] + [pa.array(a, pa.int64()), pa.array(b, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "at", "feature", "bin", "left", "right", "a", "b"])

    dealt = rows.mapInArrow(place, "part int, node int, label int, cells array<int>")
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("node").select("node", "label", "cells")
    grown = dealt.mapInArrow(grow, "node int, at int, feature int, bin int, left int, right int, a long, b long").toArrow()
    grown = grown.sort_by([("node", "ascending"), ("at", "ascending")]).combine_chunks()
    out = {}
    for node, (found,) in _runs(grown.to_batches()):
        lists = [found.column(c).to_pylist() for c in ("feature", "bin", "left", "right")]
        counts = list(zip(found.column("a").to_pylist(), found.column("b").to_pylist()))
        out[int(node)] = Nodes(*lists, counts, [0] * len(counts))
    return out


def grow(rows: DataFrame, size: int, max_depth: int) -> tuple[Nodes, np.ndarray]:
    """The tree of rows (label 0 or 1, idx, val) of ``size`` features, and the borders of the bins."""
    values = stage(rows.select("label", "idx", "val"), "tree_values")
    classes = {r["label"]: r["count"] for r in values.groupBy("label").count().collect()}
    if not classes or not set(classes) <= {0, 1}:
        raise ValueError(f"a tree needs rows of the classes 0 and 1, found {classes}")
    count = sum(classes.values())
    cuts, many = _cuts(values, size, count, min(BINS, count))
    zero = (cuts < 0).sum(axis=1)
    cells = stage(_cells(values, cuts, zero), "tree_cells")
    free(values)
    nodes = Nodes()
    held = {nodes.add((classes.get(0, 0), classes.get(1, 0)), 0): cells.agg(F.sum(F.size("cells"))).first()[0]}
    todo, small = [0], {}
    while todo:
        small |= {x: held[x] for x in todo if 0 < held[x] <= ALONE}
        large, todo = [x for x in todo if held[x] > ALONE], []
        for low in range(0, len(large), TOGETHER):
            group = large[low : low + TOGETHER]
            for node, (_, feature, last, left, own) in sorted(_counted(cells, nodes, group, held, many, zero).items()):
                children = nodes.split(node, feature, last, left)
                held |= dict(zip(children, (own, held[node] - own)))
                todo += [x for x in children if not nodes.ends(x, max_depth)]
    for node, below in (_grown_below(cells, nodes, small, many, zero, max_depth) if small else {}).items():
        number = {0: node}
        for at in range(len(below.feature)):
            if below.feature[at] >= 0:
                low, high = below.left[at], below.right[at]
                number[low], number[high] = nodes.split(number[at], below.feature[at], below.bin[at], below.counts[low])
    free(cells)
    return nodes.pruned(), cuts
