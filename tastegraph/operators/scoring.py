"""Game scores and game features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions import scoring as S
from tastegraph.operators.joins import join_scores_counts, join_scores_tags


def weigh_reviews(df: DataFrame, confidence: Column | None = None) -> DataFrame:
    """(app_id, weight) per review; ``signed_conf`` is the default confidence."""
    c = F.col("signed_conf") if confidence is None else confidence
    weight = S.review_weight(F.col("review_score"), F.col("review_votes"), c)
    return df.withColumn("weight", weight)


def game_score(weighed: DataFrame) -> DataFrame:
    """Sum of review weights per game (partial sums before the shuffle)."""
    return weighed.groupBy(F.col("app_id").alias("game_id")).agg(F.sum("weight").alias("score"))


def occurrences(reviews: DataFrame) -> DataFrame:
    """Raw reviews per game, with nulls and repeats."""
    counts = reviews.filter(F.col("app_id").isNotNull()).groupBy(F.col("app_id").alias("game_id"))
    return counts.agg(F.count(F.lit(1)).alias("occurrence"))


def normalize_scores(
    scores: DataFrame, reviews: DataFrame, k: float = K.NORMALISATION_K
) -> DataFrame:
    """(game_id, score, occurrence, normalized_score)."""
    counted = join_scores_counts(scores, occurrences(reviews))
    return counted.withColumn(
        "normalized_score", S.normalized_score(F.col("score"), F.col("occurrence"), k)
    )


def game_features(
    scores: DataFrame, reviews: DataFrame, tags: DataFrame, k: float = K.NORMALISATION_K
) -> DataFrame:
    """(game_id, normalized_score, categories, occurrence, score) of tagged games."""
    joined = join_scores_tags(normalize_scores(scores, reviews, k), tags)
    return joined.select("game_id", "normalized_score", "categories", "occurrence", "score")
