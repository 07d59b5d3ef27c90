"""Streams to recommendations: drain the topics, then score and recommend in batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.operators.cleaning import cast_key
from tastegraph.operators.nested import collect_tags
from tastegraph.operators.recommender import recommend
from tastegraph.operators.scoring import game_features
from tastegraph.plans.scoring import convert_reviews, fit_scorer, score_games
from tastegraph.schemas import PLACE
from tastegraph.sources.batch import materialize_if_absent, path_exists
from tastegraph.streaming import ingest


@dataclass(frozen=True)
class LiveTables:
    """Batch tables drained from the three topics, with BIGINT ids."""

    reviews: DataFrame
    tags: DataFrame
    playtimes: DataFrame


def drain_topics(
    spark: SparkSession, reviews: DataFrame, tags: DataFrame, users: DataFrame, root: str
) -> LiveTables | None:
    """Drain the three message streams below ``root``; None until all hold rows."""
    flows = {
        "reviews": ingest.stream_reviews(reviews),
        "tags": ingest.stream_game_tags(tags, PLACE),
        "playtimes": ingest.stream_user_games(users, PLACE, position=True),
    }
    tables = {}
    for name, rows in flows.items():
        ingest.drain(rows, f"{root}/{name}", f"{root}/checkpoints/{name}")
        # A topic without messages has left no files to take a schema from.
        stored = path_exists(spark, f"{root}/{name}/_spark_metadata")
        reader = spark.read.schema(rows.schema)
        tables[name] = (
            reader.parquet(f"{root}/{name}") if stored else spark.createDataFrame([], rows.schema)
        )
    if not ingest.await_nonempty_inputs(list(tables.values())):
        return None
    return LiveTables(
        live_reviews(tables["reviews"]), live_tags(tables["tags"]), live_playtimes(tables["playtimes"])
    )


def live_reviews(rows: DataFrame) -> DataFrame:
    """Wire reviews to the batch table: target becomes the score, votes are 0."""
    return cast_key(rows, "app_id").select(
        F.col("id").cast("long").alias("review_id"),
        "app_id",
        "app_name",
        F.col("text").alias("review_text"),
        F.expr("try_cast(sentiment_target AS INT)").alias("review_score"),
        F.lit(0).alias("review_votes"),
    )


def live_tags(rows: DataFrame) -> DataFrame:
    """One list per game in the order tags first came; a tag sent twice counts once."""
    ids = cast_key(rows, "app_id").filter(F.col("app_id").isNotNull())
    cells = ids.groupBy("app_id", "category").agg(F.min(F.struct(*PLACE)).alias("pos"))
    return collect_tags(cells).withColumnRenamed("app_id", "game_id")


def live_playtimes(rows: DataFrame) -> DataFrame:
    """Latest playtime per user and game."""
    ids = cast_key(cast_key(rows, "app_id"), "user_id").na.drop("any", subset=["app_id", "user_id"])
    latest = ids.groupBy("user_id", F.col("app_id").alias("game_id"))
    newest = F.struct(*PLACE, "pos")
    return latest.agg(F.max_by("playtime_forever", newest).alias("playtime_forever"))


def stream_to_recommendations(
    tables: LiveTables,
    root: str,
    kind: str = "sgd",
    stem: bool = True,
    max_features: int = K.SCORER_VOCABULARY,
    k: int = K.TOP_N,
    threshold: float = K.SCORE_THRESHOLD,
) -> DataFrame:
    """Classify, score, normalise and recommend over one snapshot of the tables."""
    spark = tables.reviews.sparkSession
    converted = materialize_if_absent(
        spark, f"{root}/converted", lambda: convert_reviews(tables.reviews, stem), [tables.reviews]
    )
    vocabulary, model = fit_scorer(converted, kind, max_features)
    games = materialize_if_absent(
        spark,
        f"{root}/games",
        lambda: game_features(
            score_games(converted, vocabulary, model), tables.reviews, tables.tags
        ),
        [tables.reviews, tables.tags],
    )
    return recommend(tables.tags, tables.playtimes, games, tables.reviews, k, threshold)
