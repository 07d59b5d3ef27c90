"""Equi-joins of the scoring and recommendation jobs.

No side is forced to broadcast: Spark broadcasts on measured size, and adaptive
execution splits partitions of popular games or heavy users.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_scores_counts(scores: DataFrame, counts: DataFrame) -> DataFrame:
    """Every scored game with its number of reviews."""
    return scores.join(counts, "game_id", "left")


def join_scores_tags(scores: DataFrame, tags: DataFrame) -> DataFrame:
    """Scored games that have a tag list."""
    return scores.join(tags, "game_id", "inner")


def join_tags_playtime(tags: DataFrame, playtimes: DataFrame) -> DataFrame:
    """Every playtime row, with the tag list of its game where there is one."""
    return tags.join(playtimes, "game_id", "right")


def join_interactions(playtimes: DataFrame, games: DataFrame) -> DataFrame:
    """Playtimes of games that have both a score and tags."""
    return playtimes.join(games.select("game_id", "normalized_score", "score"), "game_id", "inner")


def game_names(reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """One name per game: the first non-null one by review id."""
    named = reviews.filter(F.col("app_name").isNotNull())
    return named.groupBy("app_id").agg(F.min_by("app_name", key).alias("app_name"))


def join_names(games: DataFrame, reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """Attach names; names are reduced to one row per game before the join."""
    names = game_names(reviews, key).withColumnRenamed("app_id", "game_id")
    return games.join(names, "game_id", "left")


def exclude_owned(candidates: DataFrame, owned: DataFrame) -> DataFrame:
    """Drop (user, game) pairs the user already has."""
    return candidates.join(owned.select("user_id", "game_id"), ["user_id", "game_id"], "left_anti")


def owned_games(playtimes: DataFrame, user_id) -> DataFrame:
    """Games of one user."""
    return playtimes.filter(F.col("user_id") == user_id).select("game_id")


def union_all_frames(frames: list[DataFrame]) -> DataFrame:
    """Append tables, matching columns by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
