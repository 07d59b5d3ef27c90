"""Confusion counts, metrics, model comparison, labelled benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.scoring import percent


def _cell(label: int, predicted: int) -> Column:
    hit = (F.col("label") == label) & (F.col("prediction") == predicted)
    return F.sum(hit.cast("long"))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Counts of all four (label, prediction) cells, zeros included, in one pass."""
    cells = [(a, b) for a in (-1, 1) for b in (-1, 1)]
    wide = predictions.agg(
        *[F.coalesce(_cell(a, b), F.lit(0)).alias(f"c{i}") for i, (a, b) in enumerate(cells)]
    )
    rows = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"c{i}").alias("n"))
        for i, (a, b) in enumerate(cells)
    ]
    return wide.select(F.inline(F.array(*rows)))


def classification_metrics(predictions: DataFrame, by: str | None = None) -> DataFrame:
    """F1, precision, recall (class 1) and accuracy in percent, overall or per model."""
    grouped = predictions.groupBy(by) if by else predictions.groupBy()
    counts = grouped.agg(
        _cell(1, 1).alias("tp"),
        _cell(-1, 1).alias("fp"),
        _cell(1, -1).alias("fn"),
        _cell(-1, -1).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def ratio(a: Column, b: Column, name: str) -> Column:
        return percent(F.coalesce(F.try_divide(a, b), F.lit(0.0))).alias(name)

    return counts.select(
        *([by] if by else []),
        ratio(tp * 2, tp * 2 + fp + fn, "f1"),
        ratio(tp, tp + fp, "precision"),
        ratio(tp, tp + fn, "recall"),
        ratio(tp + tn, tp + fp + fn + tn, "accuracy"),
    )


def sort_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("f1"), "model")


def model_comparison(predictions: DataFrame) -> DataFrame:
    """Metrics of every model of a long prediction table, best F1 first."""
    return sort_models(classification_metrics(predictions, by="model"))


def benchmark_hit(exact: bool = False) -> Column:
    """A hit is the right label; ``exact`` asks for full confidence as well."""
    right = F.col("prediction") == F.col("label")
    if not exact:
        return right
    certain = F.greatest(F.col("p_positive"), 1 - F.col("p_positive")) == 1.0
    return right & certain


def labelled_benchmark(predictions: DataFrame, exact: bool = False) -> DataFrame:
    """Right answers and size of the benchmark per model."""
    return predictions.groupBy("model").agg(
        F.sum(benchmark_hit(exact).cast("long")).alias("hits"), F.count(F.lit(1)).alias("n")
    )


def benchmark_misses(predictions: DataFrame, exact: bool = False) -> DataFrame:
    """The misses themselves, one row each, so that the list may be of any length."""
    return predictions.filter(~benchmark_hit(exact))
