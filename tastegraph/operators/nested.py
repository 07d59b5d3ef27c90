"""Reshaping and nested data: tags, owned games, JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastegraph.functions.arrays import last_per_id
from tastegraph.functions.text import extract_links, url_unquote
from tastegraph.operators.ranking import rank_within
from tastegraph.schemas import PLAYTIME_FIELDS


def unpivot_tags(wide: DataFrame) -> DataFrame:
    """Wide tag table (a column per game) to (game_id, categories), nulls dropped."""
    return wide.unpivot([], wide.columns, "game_id", "categories").na.drop()


def unpivot_cells(wide: DataFrame, position: str = "pos") -> DataFrame:
    """As ``unpivot_tags`` but null cells and the row position are kept."""
    games = [c for c in wide.columns if c != position]
    return wide.unpivot([position], games, "app_id", "category")


def pivot_tags_wide(cells: DataFrame, app_ids: Sequence[int]) -> DataFrame:
    """Long cells to the wide export: one column per game, one row per position.

    A wide table has as many columns as games, so this is an export for a list of
    ids given by the caller; the long form is the working form.
    """
    return (
        cells.groupBy("pos")
        .pivot("app_id", list(app_ids))
        .agg(F.first("category", ignorenulls=True))
        .orderBy("pos")
    )


def transpose_tags_nested(cells: DataFrame) -> DataFrame:
    """(app_id, pos, category or null) to one ordered list per game, ``[]`` kept.

    A list holds the tags of one store page.
    """
    placed = F.struct("pos", "category")
    listed = F.array_sort(F.collect_list(F.when(F.col("category").isNotNull(), placed)))
    return cells.groupBy("app_id").agg(
        F.transform(listed, lambda s: s["category"]).alias("categories")
    )


def collect_tags(tags: DataFrame) -> DataFrame:
    """Long tags to one ordered list per game; games without tags vanish."""
    return transpose_tags_nested(tags.filter(F.col("category").isNotNull()))


def collect_review_texts(
    reviews: DataFrame, chunk: int = 1000, key: str = "review_id", text: str = "review_text"
) -> DataFrame:
    """All texts of a game, in id order, as numbered lists of at most ``chunk`` texts.

    One game may hold a large share of all reviews. Its texts are therefore split
    over several rows; the chunks of a game together are its whole list.
    """
    ranked = rank_within(
        reviews.select("app_id", key, text), ["app_id"], [F.col(key)], "rank"
    )
    number = F.floor((F.col("rank") - 1) / chunk).alias("chunk")
    placed = F.array_sort(F.collect_list(F.struct("rank", text)))
    return ranked.groupBy("app_id", number).agg(
        F.transform(placed, lambda s: s[text]).alias("texts")
    )


def explode_tags_outer(nested: DataFrame, items: str = "categories") -> DataFrame:
    """One row per item; a null or empty list gives one row with a null item."""
    return nested.withColumn(items, F.explode_outer(items))


def explode_tags(nested: DataFrame) -> DataFrame:
    """One row per tag; games with an empty list vanish."""
    return nested.select("app_id", F.explode("categories").alias("category"))


def explode_user_games(documents: DataFrame) -> DataFrame:
    """Owned-games documents to one row per user and game."""
    games = documents.select("user_id", F.explode("games").alias("g"))
    return games.select(
        "user_id", F.col("g.appid").alias("app_id"), *[F.col(f"g.{f}") for f in PLAYTIME_FIELDS]
    )


def parse_json_records(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """JSON text to a struct column; malformed input gives null fields."""
    return messages.withColumn("json", F.from_json(F.col(value).cast("string"), schema))


def flatten_struct(df: DataFrame, column: str = "json") -> DataFrame:
    return df.select(f"{column}.*")


def playtime_map(games: Column) -> Column:
    """``{appid: playtime_forever}`` of one list; a repeated id keeps its last value."""
    return last_per_id(games["appid"], games["playtime_forever"])


def tags_from_pages(pages: DataFrame, pattern: str, html: str = "html") -> DataFrame:
    """Tag slugs of landed store pages, decoded, in page order, repeats kept.

    ``pattern`` needs the slug as its second capture group, for instance
    ``href="(https://<store-host>/tags/en/([^/]+)/)``.
    """
    slugs = F.transform(extract_links(F.col(html), pattern), url_unquote)
    return pages.withColumn("categories", slugs)
