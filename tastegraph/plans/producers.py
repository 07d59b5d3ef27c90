"""Producer jobs: batch tables to the messages of the three topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions.text import convert_text
from tastegraph.operators.cleaning import REVIEW_COLUMNS, distinct_reviews, drop_null_rows
from tastegraph.operators.nested import transpose_tags_nested
from tastegraph.operators.ranking import assign_row_id, first_rows, sample_exact_n
from tastegraph.session import stage
from tastegraph.sources import batch, topics
from tastegraph.streaming import ingest

#: What takes a table of messages to a topic.
Send = Callable[[DataFrame, str], None]


def review_messages(
    reviews: DataFrame,
    sample: int | None = 25_000,
    cap: int | None = None,
    key: str = "review_id",
    stem: bool = True,
    seed: int = K.SPLIT_SEED,
) -> DataFrame:
    """Review messages (id, app_id, app_name, sentiment_target, text, converted_text).

    Of at most the first ``cap`` reviews those without nulls are kept, ``sample`` of them
    are drawn, repeats dropped, the rest numbered from 0 in key order and converted.
    """
    rows = first_rows(reviews, [F.col(key)], cap) if cap is not None else reviews
    rows = drop_null_rows(rows.select(key, *REVIEW_COLUMNS), REVIEW_COLUMNS)
    if sample is not None:
        rows = sample_exact_n(rows, F.col(key), sample, seed)
    once = distinct_reviews(stage(rows, "sampled"), key, REVIEW_COLUMNS)
    numbered = assign_row_id(once.select(key), [F.col(key)], "id")
    # Numbers are dealt out on the keys alone; texts are joined back once.
    return once.join(numbered, key).select(
        "id",
        F.col("app_id").cast("string").alias("app_id"),
        "app_name",
        F.col("review_score").cast("string").alias("sentiment_target"),
        F.col("review_text").alias("text"),
        convert_text(F.col("review_text"), stem).alias("converted_text"),
    )


def tag_messages(cells: DataFrame) -> DataFrame:
    """One message per game with its tags in order; games without tags send an empty list."""
    lists = transpose_tags_nested(cells)
    return lists.select(F.col("app_id").cast("string").alias("app_id"), "categories")


def wide_tag_cells(wide: DataFrame) -> DataFrame:
    """Cells of a wide tag table (a column per game), rows in file order."""
    listed = [F.struct(F.lit(c).alias("app_id"), F.col(f"`{c}`").cast("string").alias("category")) for c in wide.columns]
    placed = wide.withColumn("__pos", F.monotonically_increasing_id())
    return placed.select(F.col("__pos").alias("pos"), F.inline(F.array(*listed)))


def user_messages(answers: DataFrame) -> DataFrame:
    """One message per landed answer with its games; failed and empty answers send none."""
    games = batch.owned_games_documents(answers)
    return games.select(F.col("user_id").cast("string").alias("user_id"), "games")


def to_files(path: str) -> Send:
    """Messages as JSON lines below a folder, for ``topics.file_topic``."""
    return lambda rows, topic: topics.sink_json_files(rows, path, topic)


def to_broker(host_port: str) -> Send:
    return lambda rows, topic: topics.sink_json_topic(rows, host_port, topic)


def produce_reviews(reviews: DataFrame, send: Send, **options) -> None:
    send(review_messages(reviews, **options), ingest.REVIEWS_TOPIC)


def produce_tags(spark: SparkSession, path: str, send: Send) -> None:
    """The wide tag CSV at ``path`` to the tags topic."""
    send(tag_messages(wide_tag_cells(batch.scan_tags_wide(spark, path))), ingest.TAGS_TOPIC)


def produce_user_games(answers: DataFrame, send: Send) -> None:
    send(user_messages(answers), ingest.USERS_TOPIC)
