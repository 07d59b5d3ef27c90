"""Binary classifiers over sparse TF-IDF arrays.

All four end up as at most a few thousand numbers per class, so scoring is an
expression over the row's own arrays: no join, no Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.arrays import dot, literal_doubles
from tastegraph.functions.scoring import huber_probability

VARIANCE_SMOOTHING = 1e-9


@dataclass(frozen=True)
class TermClassifier:
    """margin = intercept + sum(linear * x) + sum(quadratic * x * x).

    ``presence`` replaces x by 1 where it is positive. ``link`` turns the margin
    into the probability of class 1.
    """

    name: str
    intercept: float
    linear: tuple[float, ...]
    quadratic: tuple[float, ...] | None = None
    presence: bool = False
    link: str = "logistic"

    def margin(self, idx: Column, val: Column) -> Column:
        x = F.transform(val, lambda _: F.lit(1.0)) if self.presence else val
        total = F.lit(self.intercept) + dot(idx, x, literal_doubles(self.linear))
        if self.quadratic is not None:
            squares = F.transform(val, lambda v: v * v)
            total = total + dot(idx, squares, literal_doubles(self.quadratic))
        return total

    def p_positive(self, idx: Column, val: Column) -> Column:
        margin = self.margin(idx, val)
        if self.link == "huber":
            return huber_probability(margin)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def predict(df: DataFrame, model: TermClassifier) -> DataFrame:
    """Add ``p_positive`` and ``prediction`` (-1 or 1)."""
    scored = df.withColumn("p_positive", model.p_positive(F.col("idx"), F.col("val")))
    return scored.withColumn("prediction", F.when(F.col("p_positive") > 0.5, 1).otherwise(-1))


def predict_all(df: DataFrame, models: Sequence[TermClassifier], keep: Sequence[str]) -> DataFrame:
    """Predictions of several models in long form from one read of the features."""
    cells = []
    for model in models:
        p = model.p_positive(F.col("idx"), F.col("val"))
        cells.append(
            F.struct(
                F.lit(model.name).alias("model"),
                p.alias("p_positive"),
                F.when(p > 0.5, 1).otherwise(-1).alias("prediction"),
            )
        )
    return df.select(*keep, F.inline(F.array(*cells)))


@dataclass(frozen=True)
class _ClassSums:
    counts: dict[int, int]
    sums: dict[int, list[float]]
    squares: dict[int, list[float]]
    present: dict[int, list[int]]


def _class_sums(train: DataFrame, label: str, size: int) -> _ClassSums:
    """Per class and term: sum, sum of squares and documents; 2 x size rows come back."""
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    pairs = train.select(label, F.explode(F.arrays_zip("idx", "val")).alias("p"))
    rows = (
        pairs.groupBy(label, F.col("p.idx").alias("i"))
        .agg(
            F.sum("p.val").alias("s"),
            F.sum(F.col("p.val") * F.col("p.val")).alias("q"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    )
    empty = {c: [0.0] * size for c in counts}
    result = _ClassSums(
        counts, empty, {c: [0.0] * size for c in counts}, {c: [0] * size for c in counts}
    )
    for row in rows:
        result.sums[row[label]][row["i"]] = row["s"]
        result.squares[row[label]][row["i"]] = row["q"]
        result.present[row[label]][row["i"]] = row["n"]
    if set(counts) != {-1, 1}:
        raise ValueError(f"training needs the classes -1 and 1, found {sorted(counts)}")
    return result


def _prior(sums: _ClassSums) -> float:
    return math.log(sums.counts[1]) - math.log(sums.counts[-1])


def _multinomial(sums: _ClassSums, size: int) -> TermClassifier:
    log_p = {}
    for c in (-1, 1):
        total = sum(sums.sums[c]) + size
        log_p[c] = [math.log(s + 1.0) - math.log(total) for s in sums.sums[c]]
    linear = tuple(a - b for a, b in zip(log_p[1], log_p[-1]))
    return TermClassifier("multinomial_nb", _prior(sums), linear)


def _bernoulli(sums: _ClassSums, size: int) -> TermClassifier:
    p = {c: [(n + 1) / (sums.counts[c] + 2) for n in sums.present[c]] for c in (-1, 1)}
    absent = sum(math.log(1 - a) - math.log(1 - b) for a, b in zip(p[1], p[-1]))
    linear = tuple(
        math.log(a / (1 - a)) - math.log(b / (1 - b)) for a, b in zip(p[1], p[-1])
    )
    return TermClassifier("bernoulli_nb", _prior(sums) + absent, linear, presence=True)


def _gaussian(sums: _ClassSums, size: int) -> TermClassifier:
    n = sum(sums.counts.values())
    overall = [
        (sums.squares[-1][i] + sums.squares[1][i]) / n
        - ((sums.sums[-1][i] + sums.sums[1][i]) / n) ** 2
        for i in range(size)
    ]
    smoothing = VARIANCE_SMOOTHING * max(overall)
    mean, variance = {}, {}
    for c in (-1, 1):
        mean[c] = [s / sums.counts[c] for s in sums.sums[c]]
        variance[c] = [
            max(q / sums.counts[c] - m * m, 0.0) + smoothing
            for q, m in zip(sums.squares[c], mean[c])
        ]

    def at_zero(c: int) -> float:
        return sum(
            -0.5 * math.log(2 * math.pi * v) - m * m / (2 * v)
            for m, v in zip(mean[c], variance[c])
        )

    linear = tuple(
        mean[1][i] / variance[1][i] - mean[-1][i] / variance[-1][i] for i in range(size)
    )
    quadratic = tuple(0.5 / variance[-1][i] - 0.5 / variance[1][i] for i in range(size))
    intercept = _prior(sums) + at_zero(1) - at_zero(-1)
    return TermClassifier("gaussian_nb", intercept, linear, quadratic)


FITTERS = {"multinomial_nb": _multinomial, "bernoulli_nb": _bernoulli, "gaussian_nb": _gaussian}


def fit_naive_bayes(
    train: DataFrame, size: int, kinds: Sequence[str] = ("multinomial_nb",), label: str = "review_score"
) -> list[TermClassifier]:
    """Fit any of the three naive Bayes variants from one set of class sums.

    ``train`` holds ``idx``/``val`` arrays over a vocabulary of ``size`` terms.
    """
    sums = _class_sums(train, label, size)
    return [FITTERS[kind](sums, size) for kind in kinds]


def save_classifier(spark: SparkSession, model: TermClassifier, path: str) -> None:
    """Weights as a Parquet table, one row per term and one for the intercept."""
    quadratic = model.quadratic or [None] * len(model.linear)
    rows = [(i, w, q) for i, (w, q) in enumerate(zip(model.linear, quadratic))]
    rows.append((-1, model.intercept, None))
    table = spark.createDataFrame(rows, "idx int, linear double, quadratic double")
    table.withColumns(
        {
            "name": F.lit(model.name),
            "presence": F.lit(model.presence),
            "link": F.lit(model.link),
        }
    ).write.mode("overwrite").parquet(path)


def load_classifier(spark: SparkSession, path: str) -> TermClassifier:
    rows = spark.read.parquet(path).orderBy("idx").collect()
    head, terms = rows[0], rows[1:]
    model = TermClassifier(
        head["name"], head["linear"], tuple(r["linear"] for r in terms),
        presence=head["presence"], link=head["link"],
    )
    if terms and terms[0]["quadratic"] is not None:
        model = replace(model, quadratic=tuple(r["quadratic"] for r in terms))
    return model
