"""Mixing sources to target weights by pivotal dependent rounding.

A source's words are to appear ``rate = target / size`` times. Each of its documents gets
the whole part of the rate as copies; the fractional part is a probability for one copy
more. The pivotal method rounds these together: two documents with fractional
probabilities exchange expected words until one of them is 0 or 1, in a random direction
that leaves each probability right on average. The words taken stay the same in every
step, so a source misses its target by less than one document.

The exchange runs in blocks of documents chosen by a hash. A block leaves at most one
fractional document per source; those residuals meet in the next level's blocks, and so
on, until each source has one left, which is rounded at random. No level gathers more
than a block's worth of rows, and every draw is a hash of ids, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm import words
from tastegraph.llm.common import given_back, plain, stage, text_key

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Sources that a mix can have; their table is what is broadcast.
MOST_SOURCES = 100_000
BLOCK_ROWS = 50_000
SEED = 10


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, text_key, size): the number of words of every whole text."""

    def work(batches):
        for batch in batches:
            count = [block.count for block in words.blocks(batch.column(3))]
            count = pa.array(np.concatenate(count) if count else [], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], count], ["id", "source", "text_key", "size"])

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        text_key(text_col).alias("text_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, source string, text_key long, size long")


def targets(sources: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST_COPIES) -> dict[str | None, float]:
    """Words that each source should have: shares of all words by weight, ``most`` times at most.

    What is above the bound is shared out again by weight among the others until none is
    above it.
    """
    ordered = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: float(weights[i % len(weights)]) for i, (name, _) in enumerate(ordered)}
    size = dict(ordered)
    out = dict.fromkeys(size, 0.0)
    left, free = float(sum(size.values())), list(size)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * size[s]]
        if not over:
            for s in free:
                out[s] = left * weight[s] / total
            break
        for s in over:
            out[s] = float(most * size[s])
        left -= sum(most * size[s] for s in over)
        free = [s for s in free if s not in over]
    return out


def _draw(a: int, b: int) -> float:
    """A number from [0, 1) that depends on two keys only."""
    mixed = ((a & 0xFFFFFFFFFFFFFFFF) * 0x9E3779B97F4A7C15 + (b & 0xFFFFFFFFFFFFFFFF) + SEED) & 0xFFFFFFFFFFFFFFFF
    mixed = ((mixed ^ (mixed >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    mixed = ((mixed ^ (mixed >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((mixed ^ (mixed >> 31)) >> 11) / (1 << 53)


def pivot(keys: list[int], amounts: list[int], chances: list[float], last: bool = False) -> list[float]:
    """Chances after the exchange: all 0 or 1 but for one at most (none if ``last``)."""
    out = list(chances)
    open_at = None
    for at, chance in enumerate(out):
        if not 0.0 < chance < 1.0:
            continue
        if open_at is None:
            open_at = at
            continue
        p, q, m, n = out[open_at], chance, amounts[open_at], amounts[at]
        up = min((1 - p) * m, q * n)  # words that can move to the first
        down = min(p * m, (1 - q) * n)
        if _draw(keys[open_at], keys[at]) * (up + down) < down:
            moved, p_end, q_end = up, (1 - p) * m <= q * n, q * n <= (1 - p) * m
            p, q = (1.0 if p_end else p + moved / m), (0.0 if q_end else q - moved / n)
        else:
            moved, p_end, q_end = down, p * m <= (1 - q) * n, (1 - q) * n <= p * m
            p, q = (0.0 if p_end else p - moved / m), (1.0 if q_end else q + moved / n)
        out[open_at], out[at] = p, q
        open_at = open_at if 0.0 < p < 1.0 else at if 0.0 < q < 1.0 else None
    if last and open_at is not None:
        out[open_at] = 1.0 if _draw(keys[open_at], 1) < out[open_at] else 0.0
    return out


def _level(units: DataFrame, last: bool) -> DataFrame:
    """One level of the tree: the pivotal exchange within each (source, block)."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("id", "ascending"), ("text_key", "ascending")])
        chance = pivot(table["draw"].to_pylist(), table["amount"].to_pylist(), table["chance"].to_pylist(), last)
        return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(chance, pa.float64()))

    return units.groupBy("source", "block").applyInArrow(work, units.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS) -> DataFrame:
    """(id, source, text_key, size, source_size, target, copies, taken) per document.

    Null texts and texts without words have size 0 and are taken once as they are. A null
    source is a source of its own, with the last weight. Rows alike in id, source and text
    are rounded together and get equal copies. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = stage(sizes(docs, id_col, source_col, text_col), "sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    if by_source.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    # One row per source goes to the driver, and from there to the tasks.
    found = [(r["source"], int(r["source_size"])) for r in by_source.collect()]
    goal = targets(found, weights)
    plan = [(s, n, goal[s], goal[s] / n if n else 0.0) for s, n in found]
    plan = spark.createDataFrame(plan, "p_source string, source_size long, target double, rate double")
    of_source = F.col("source").eqNullSafe(F.col("p_source"))
    units = rows.where("size > 0").groupBy("id", "source", "text_key", "size").agg(F.count("*").alias("rows"))
    units = units.join(F.broadcast(plan), of_source).select(
        "id",
        "source",
        "text_key",
        "size",
        (F.col("size") * F.col("rows")).alias("amount"),
        F.floor("rate").cast("int").alias("base"),
        (F.col("rate") - F.floor("rate")).alias("chance"),
        F.xxhash64("id", "text_key", F.lit(SEED)).alias("draw"),
    )
    units = stage(units, "units")
    counted = {r["source"]: r["n"] for r in units.where("chance > 0").groupBy("source").agg(F.count("*").alias("n")).collect()}
    most = max(counted.values(), default=0)
    sure = units.where("chance = 0")
    open_units, done = units.where("chance > 0"), [sure]
    blocks = -(-most // BLOCK_ROWS)
    while True:
        level = open_units.withColumn("block", F.pmod("draw", F.lit(max(1, blocks))))
        last = blocks <= 1
        level = stage(_level(level, last), "level").drop("block")
        done.append(level.where("chance = 0 OR chance = 1"))
        if last:
            break
        open_units = level.where("chance > 0 AND chance < 1")
        blocks = -(-blocks // BLOCK_ROWS)
    decided = done[0]
    for part in done[1:]:
        decided = decided.unionByName(part)
    decided = decided.select(
        F.col("id").alias("d_id"),
        F.col("source").alias("d_source"),
        F.col("text_key").alias("d_key"),
        (F.col("base") + F.col("chance").cast("int")).alias("copies"),
    )
    with_words = rows.where("size > 0")
    same = (
        (F.col("text_key") == F.col("d_key"))
        & F.col("id").eqNullSafe(F.col("d_id"))
        & F.col("source").eqNullSafe(F.col("d_source"))
    )
    out = with_words.join(decided, same).select("id", "source", "text_key", "size", "copies")
    out = out.unionByName(rows.where("size = 0").withColumn("copies", F.lit(1)))
    out = out.join(F.broadcast(plan.drop("rate")), of_source).drop("p_source")
    return out.withColumn("taken", F.col("copies") * F.col("size")).withColumnRenamed("id", id_col)


def apply_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns."""
    taken = mix(docs, id_col, source_col, text_col, weights).where("copies > 0")
    taken = taken.select(
        F.col(id_col).alias("mix_id"),
        F.col("source").alias("mix_source"),
        F.col("text_key").alias("mix_key"),
        F.sequence(F.lit(1), F.col("copies")).alias("copies"),
    ).distinct()
    rows, at = plain(docs)
    rows = rows.withColumn("key", text_key(at[text_col]))
    same = (
        (F.col("key") == F.col("mix_key"))
        & F.col(at[id_col]).eqNullSafe(F.col("mix_id"))
        & F.col(at[source_col]).cast("string").eqNullSafe(F.col("mix_source"))
    )
    return given_back(rows.join(taken, same).select(*at.values(), F.explode("copies").alias("copy")), docs)
