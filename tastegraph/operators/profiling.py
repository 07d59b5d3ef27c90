"""Counts, distributions and descriptive statistics."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegraph import constants as K
from tastegraph.functions import text as X
from tastegraph.functions.arrays import value_counts as run_counts
from tastegraph.operators.ranking import exact_quantiles, top_k_per_group
from tastegraph.session import stage

MEASURES = ("char_num", "word_num", "sent_num")


def text_measures(df: DataFrame, text: str = "review_text") -> DataFrame:
    """Add character, word and sentence counts."""
    t = F.col(text)
    return df.withColumns(
        {"char_num": X.char_num(t), "word_num": X.word_num(t), "sent_num": X.sent_num(t)}
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Type, row count and non-null count per column, from one aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in df.columns]
    ).unpivot(["__rows"], df.columns, "column_name", "non_null")
    types = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    )
    return counts.select(
        "column_name",
        F.element_at(types, F.col("column_name")).alias("data_type"),
        F.col("__rows").alias("row_count"),
        "non_null",
    )


def value_counts(df: DataFrame, column: str, count_name: str = "n") -> DataFrame:
    """Count per value, nulls left out, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias(count_name)).orderBy(F.desc(count_name), column)


def class_share(df: DataFrame, column: str = "review_score") -> DataFrame:
    """Percent of rows per class, two decimals. The window sees one row per class."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    share = F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(share, 2))


def value_frequencies(df: DataFrame, columns: Sequence[str], group: str | None) -> DataFrame:
    """(measure, group, v, n): how often each value of each column occurs.

    One pass over the rows with map-side combine; stored, because every statistic
    below is a sum over this much smaller table.
    """
    key = F.col(group) if group else F.lit("all")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v"))
            for c in columns
        ]
    )
    rows = df.select(key.alias(group or "g"), F.inline(cells))
    rows = rows.na.drop("any", subset=[group or "g", "v"])
    counts = rows.groupBy("measure", group or "g", "v").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "value-frequencies")


def describe_numeric(
    df: DataFrame, columns: Sequence[str] = MEASURES, group: str | None = None
) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max per column, overall or per class."""
    key = group or "g"
    counts = value_frequencies(df, columns, group)
    total, v, n = F.sum("n"), F.col("v"), F.col("n")
    means = counts.groupBy("measure", key).agg(
        total.alias("n"),
        (F.sum(v * n) / total).alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    deviation = v - F.col("mean")
    spread = (
        counts.join(means.select("measure", key, "mean"), ["measure", key])
        .groupBy("measure", key)
        .agg(F.sqrt(F.try_divide(F.sum(deviation * deviation * n), total - 1)).alias("std"))
    )
    quartiles = exact_quantiles(counts, ["measure", key], "v", "n", (0.25, 0.5, 0.75))
    joined = means.join(spread, ["measure", key]).join(quartiles, ["measure", key])
    return joined.select(
        "measure", key, "n", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe_object(df: DataFrame, column: str) -> DataFrame:
    """count, unique, top and its frequency; ties go to the smallest value.

    Values are counted by 256-bit digests; only those that tie for the top are looked at.
    """
    rows = df.filter(F.col(column).isNotNull()).select(column, F.sha2(column, 256).alias("__digest"))
    counts = rows.groupBy("__digest").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"), F.max("n").alias("freq"))
    found = sums.first()
    # If no value repeats, all tie and none has to be met again.
    ties = rows if found["freq"] == 1 else rows.join(counts.where(F.col("n") == F.lit(found["freq"])), "__digest", "left_semi")
    return ties.agg(
        F.lit(found["n"]).cast("long").alias("n"),
        F.lit(found["n_unique"]).cast("long").alias("n_unique"),
        F.min(column).alias("top"),
        F.lit(found["freq"]).cast("long").alias("freq"),
    )


def max_playtime(playtimes: DataFrame) -> DataFrame:
    return playtimes.agg(F.max("playtime_forever").alias("max_playtime"))


def bin_widths(counts: DataFrame, group: str, bins: int | None = None) -> DataFrame:
    """Per group of a (group, v, n) table: lowest value, bin width, number of bins.

    Without ``bins`` the width is the smaller of the Sturges and Freedman-Diaconis
    widths (Sturges alone when the quartile range is zero).
    """
    stats = counts.groupBy(group).agg(
        F.sum("n").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    span, total = F.col("hi") - F.col("lo"), F.col("total").cast("double")
    if bins is not None:
        sized = stats.withColumn("n_bins", F.lit(bins).cast("long"))
    else:
        quartiles = exact_quantiles(counts, [group], "v", "n", (0.25, 0.75))
        sturges = span / (F.log2(total) + F.lit(1.0))
        iqr = F.col("p75") - F.col("p25")
        freedman = F.lit(2.0) * iqr / F.pow(total, F.lit(1.0) / F.lit(3.0))
        width = F.when(freedman > 0, F.least(sturges, freedman)).otherwise(sturges)
        n_bins = F.coalesce(F.ceil(F.try_divide(span, width)), F.lit(1))
        sized = stats.join(quartiles, group).withColumn("n_bins", n_bins.cast("long"))
    return sized.select(group, "lo", "n_bins", (span / F.col("n_bins")).alias("width"))


def histogram_by_class(
    df: DataFrame, column: str, group: str = "review_score", bins: int | None = None
) -> DataFrame:
    """Rows per (class, bin); the last bin is closed, empty bins are left out.

    Values are counted before they meet the bin table, so only distinct values
    are joined. The bin table has one row per class.
    """
    counts = value_frequencies(df, [column], group)
    binned = counts.join(bin_widths(counts, group, bins), group)
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("width"))), F.lit(0))
    number = F.least(place, F.col("n_bins") - 1).cast("long")
    return binned.groupBy(group, number.alias("bin")).agg(F.sum("n").alias("n"))


def term_frequency_by_class(
    df: DataFrame,
    converted: str = "converted_text",
    group: str = "review_score",
    k: int = K.WORDCLOUD_TERMS,
) -> DataFrame:
    """Most frequent terms per class with weight = count / largest count."""
    tokens = F.filter(F.split(F.col(converted), " "), lambda t: t != "")
    counted = df.select(group, F.explode(run_counts(tokens)).alias("c"))
    counts = counted.groupBy(group, F.col("c.value").alias("term")).agg(F.sum("c.n").alias("n"))
    top = top_k_per_group(counts, [group], [F.desc("n"), F.col("term")], k)
    largest = F.max("n").over(Window.partitionBy(group))
    return top.select(group, "term", "n", (F.col("n") / largest).alias("weight"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form, in one pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*cells)))


def throughput(
    df: DataFrame, action: Callable[[DataFrame], None], name: str = "throughput"
) -> dict[str, float]:
    """Run an action on ``df`` and report rows, seconds and rows per second.

    Rows are counted while the action runs, not in a pass of their own.
    """
    seen = Observation(name)
    started = time.perf_counter()
    action(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    seconds = time.perf_counter() - started
    rows = seen.get["rows"]
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds}
