"""Ordered operators: row ids, ranks, first rows, samples, exact quantiles.

A window without PARTITION BY, or with one hot partition, runs in a single task.
Here an order is cut into ranges by boundaries taken from a key sample. Every row
then needs only its place inside its range plus the number of rows in lower
ranges, so the work spreads over all tasks whatever the key distribution. The
sample decides balance only; results are exact for any boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tastegraph.session import stage

KEYS_PER_RANGE, LEAST_SAMPLED, MOST_SAMPLED = 20, 2_000, 50_000
# Bounds the literal boundaries and every per-range table below.
MAX_RANGES = 4096
# Ranges per narrowing step, and keys from which one task may find the last one.
NARROWING, FEW_KEYS = 256, 20_000
KEY = "__key"
RANGE = "__range"


def _order_key(order_by: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order_by)])


def range_boundaries(df: DataFrame, key: Column, ranges: int) -> list:
    """At most ``ranges - 1`` ascending cut points of ``key``, as driver rows."""
    if ranges < 2:
        return []
    size = min(MOST_SAMPLED, max(LEAST_SAMPLED, KEYS_PER_RANGE * ranges))
    keys = df.select(key.alias(KEY))
    # Each key is drawn on its own, so no task gathers the samples of all others.
    share = size / max(1, keys.count())
    sample = keys if share >= 1 else keys.where(F.rand(7) < share)
    rows = sample.groupBy(KEY).count().orderBy(KEY).collect()
    step = sum(r["count"] for r in rows) / ranges
    cuts, seen, target = [], 0, step
    for row in rows:
        if seen >= target and len(cuts) < ranges - 1:
            cuts.append(row[KEY])
            target = seen + step
        seen += row["count"]
    return cuts


def _literal(value, data_type) -> str:
    """A constant as SQL text; one parsed text is much faster to build than columns."""
    if value is None:
        return f"CAST(NULL AS {data_type.simpleString()})"
    if isinstance(data_type, StructType):
        fields = [
            f"'{f.name}', {_literal(value[f.name], f.dataType)}" for f in data_type.fields
        ]
        return f"named_struct({', '.join(fields)})"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {data_type.simpleString()})"


def range_number(key: Column, cuts: list, data_type) -> Column:
    """Number of cut points at or below ``key``, by binary search in a literal array."""
    if not cuts:
        return F.lit(0)
    points = F.expr(f"array({', '.join(_literal(c, data_type) for c in cuts)})")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(points, at + step - 1) <= key, at + step).otherwise(at),
    )


def _with_ranges(df: DataFrame, order_by: Sequence[Column], ranges: int | None) -> DataFrame:
    wanted = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn(KEY, _order_key(order_by))
    cuts = range_boundaries(keyed, F.col(KEY), min(wanted, MAX_RANGES))
    data_type = keyed.schema[KEY].dataType
    return keyed.withColumn(RANGE, range_number(F.col(KEY), cuts, data_type))


def running_total(
    df: DataFrame,
    order_by: Sequence[Column],
    amount: Column,
    name: str,
    ranges: int | None = None,
) -> DataFrame:
    """Add the running sum of ``amount`` in a total order over the whole table."""
    cut = _with_ranges(df, order_by, ranges).withColumn("__amount", amount)
    totals = cut.groupBy(RANGE).agg(F.sum("__amount").alias("__total"))
    # One row per range (at most MAX_RANGES), so this window and broadcast stay tiny.
    before = totals.select(
        RANGE,
        F.coalesce(
            F.sum("__total").over(
                Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("__before"),
    )
    inside = Window.partitionBy(RANGE).orderBy(KEY)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        cut.join(F.broadcast(before), RANGE)
        .withColumn(name, F.col("__before") + F.sum("__amount").over(upto))
        .drop(KEY, RANGE, "__amount", "__before")
    )


def assign_row_id(
    df: DataFrame, order_by: Sequence[Column], name: str = "id", ranges: int | None = None
) -> DataFrame:
    """Dense 0-based row id in the given total order."""
    counted = running_total(df, order_by, F.lit(1).cast("long"), name, ranges)
    return counted.withColumn(name, F.col(name) - 1)


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    name: str = "rank",
    ranges: int | None = None,
) -> DataFrame:
    """Row number 1.. inside each group; a group may be larger than one task.

    A group is spread over the ranges it covers; the counts of its lower ranges are
    summed per group (at most MAX_RANGES rows each) and joined back on the keys the
    window needs.
    """
    groups = [F.col(c) for c in partition_by]
    cut = _with_ranges(df, [*groups, *order_by], ranges)
    counts = cut.groupBy(*partition_by, RANGE).agg(F.count(F.lit(1)).alias("__n"))
    lower = Window.partitionBy(*partition_by).orderBy(RANGE)
    keys = [*partition_by, RANGE]
    before = counts.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)],
        F.coalesce(
            F.sum("__n").over(lower.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)])
    joined = cut.join(before, same).select(*cut.columns, "__before")
    inside = Window.partitionBy(*keys).orderBy(KEY)
    return joined.withColumn(
        name, F.row_number().over(inside).cast("long") + F.col("__before")
    ).drop(KEY, RANGE, "__before")


def rank_items(
    scores: DataFrame, user: str = "user_id", score: str = "predicted_score", item: str = "game_id"
) -> DataFrame:
    """All items of every user by score, best first, ties by item."""
    return rank_within(scores, [user], [-F.col(score), F.col(item)], "rank")


def top_k_per_group(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows per group; Spark prunes to k per group before it shuffles."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def rank_reset(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Number what is left of each top-k group 0..k-1 (groups are bounded by k)."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("position", F.row_number().over(window) - 1)


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in an explicit order."""
    return top_k_per_group(df, key, order_by, 1).drop("rank")


def first_rows(df: DataFrame, order_by: Sequence[Column], n: int, few: int = FEW_KEYS) -> DataFrame:
    """Exactly the first ``n`` rows of a total order, without sorting wide rows.

    The n-th key is found on the key columns alone: ranges are counted and the one that
    holds it is cut again, until few keys or only equal ones are left. The rows are then
    one filter over the scan.
    """
    keyed = df.withColumn(KEY, _order_key(order_by))
    if n <= 0:
        return df.limit(0)
    # Stored, because every narrowing step reads the keys several times.
    keys = stage(keyed.select(KEY), "keys")
    data_type = keyed.schema[KEY].dataType
    remaining, total = n, keys.count()
    if total <= n:
        return df
    while total > few:
        cuts = range_boundaries(keys, F.col(KEY), NARROWING)
        numbered = keys.withColumn(RANGE, range_number(F.col(KEY), cuts, data_type))
        counts = {r[RANGE]: r["count"] for r in numbered.groupBy(RANGE).count().collect()}
        for number in sorted(counts):
            if counts[number] >= remaining:
                break
            remaining -= counts[number]
        if counts[number] == total:
            break
        total = counts[number]
        keys = numbered.filter(F.col(RANGE) == number).select(KEY)
    low, high = keys.agg(F.min(KEY), F.max(KEY)).first()
    last = low if low == high else keys.orderBy(KEY).limit(remaining).agg(F.max(KEY)).first()[0]
    return keyed.filter(F.col(KEY) <= F.expr(_literal(last, data_type))).drop(KEY)


def sample_exact_n(df: DataFrame, key: Column, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement, repeatable for a seed and unique key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return first_rows(df, [digest, key], n)


def exact_quantiles(
    counts: DataFrame, group: Sequence[str], value: str, n: str, probabilities: Sequence[float]
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column ``p<percent>`` each.

    ``counts`` holds one row per group and distinct value with its frequency, so the
    ordered part never sees repeats and no group has to fit into one task.
    """
    order = [*[F.col(g) for g in group], F.col(value)]
    ends = running_total(counts, order, F.col(n), "upto")
    spans = ends.groupBy(*group).agg(
        F.sum(n).alias("size"), F.min(F.col("upto") - F.col(n)).alias("start")
    )
    placed = ends.join(spans, list(group)).select(
        *group,
        "size",
        F.col(value).alias("v"),
        (F.col("upto") - F.col(n) - F.col("start")).alias("low"),
        (F.col("upto") - F.col("start") - 1).alias("high"),
    )

    def at(p: float) -> Column:
        return (F.col("size") - 1) * F.lit(float(p))

    def value_at(position: Column) -> Column:
        hit = (position >= F.col("low")) & (position <= F.col("high"))
        return F.max(F.when(hit, F.col("v")))

    sides = []
    for i, p in enumerate(probabilities):
        sides.append(value_at(F.floor(at(p))).alias(f"f{i}"))
        sides.append(value_at(F.ceil(at(p))).alias(f"c{i}"))
    picked = placed.groupBy(*group, "size").agg(*sides)
    columns = [
        (F.col(f"f{i}") + (F.col(f"c{i}") - F.col(f"f{i}")) * (at(p) - F.floor(at(p)))).alias(
            f"p{round(p * 100)}"
        )
        for i, p in enumerate(probabilities)
    ]
    return picked.select(*group, *columns)
