"""Profiles, features, scores and recommendations for all users.

Content score of a user and a game: sum over the game's tags of the user's playtime
share in that tag, times the tag's weight in the game.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegraph import constants as K
from tastegraph.operators.blocked import ITEM_ROWS, VectorBlock, block_top_k
from tastegraph.operators.hybrid import train_hybrid
from tastegraph.operators.joins import join_interactions, join_names
from tastegraph.operators.ranking import assign_row_id, rank_reset
from tastegraph.session import stage

# Scores that differ by rounding noise only are ties.
DECIMALS = 12


def index_entities(df: DataFrame, key: str) -> DataFrame:
    """Dense 0-based index of the distinct keys in key order."""
    distinct = df.filter(F.col(key).isNotNull()).select(key).distinct()
    return assign_row_id(distinct, [F.col(key)], "idx")


def item_features(games: DataFrame) -> DataFrame:
    """(game_id, feature, weight): the game itself and its tags, weights sum to 1.

    A tag listed twice counts twice.
    """
    weight = F.lit(1.0) / (F.size("categories") + 1)
    names = F.concat(
        F.array(F.concat(F.lit("game:"), F.col("game_id").cast("string"))),
        F.transform("categories", lambda c: F.concat(F.lit("tag:"), c)),
    )
    rows = games.select("game_id", F.explode(names).alias("feature"), weight.alias("w"))
    return rows.groupBy("game_id", "feature").agg(F.sum("w").alias("weight"))


def user_category_profile(tags: DataFrame, playtimes: DataFrame) -> DataFrame:
    """(user_id, category, user_category_score): playtime summed over tagged games."""
    joined = near_users(playtimes.join(tags, "game_id", "inner").select("user_id", "categories", "playtime_forever"))
    rows = joined.select("user_id", F.explode("categories").alias("category"), "playtime_forever")
    return user_category_score(rows)


def near_users(tagged: DataFrame) -> DataFrame:
    """Rows with tag lists, a user's together, for sums per user and category.

    Then the partial sums of a task are its users' categories; with users scattered over all
    tasks they are nearly as many as the exploded rows. Dealt by a hash of the user, so that
    sums still combine before their own shuffle and a heavy user may be split over tasks.
    """
    return tagged.withColumn("near", F.xxhash64("user_id")).hint("rebalance", F.col("near")).drop("near")


def user_category_score(exploded: DataFrame) -> DataFrame:
    """Playtime per user and category; rows without a category are left out."""
    return (
        exploded.filter(F.col("category").isNotNull())
        .groupBy("user_id", "category")
        .agg(F.sum("playtime_forever").alias("user_category_score"))
    )


def user_features(profile: DataFrame) -> DataFrame:
    """(user_id, category, weight): share of the user's playtime, summing to 1.

    The window holds one row per category of a user.
    """
    total = F.sum("user_category_score").over(Window.partitionBy("user_id"))
    share = F.coalesce(F.try_divide("user_category_score", total), F.lit(0.0))
    return profile.select("user_id", "category", share.alias("weight"))


def interactions(playtimes: DataFrame, games: DataFrame) -> DataFrame:
    """(user_id, game_id, weight) over scored games; weight is playtime."""
    joined = join_interactions(playtimes, games)
    return joined.groupBy("user_id", "game_id").agg(F.sum("playtime_forever").alias("weight"))


def _tag_weights(games: DataFrame) -> DataFrame:
    weight = F.lit(1.0) / (F.size("categories") + 1)
    rows = games.select("game_id", F.explode("categories").alias("category"), weight.alias("w"))
    return rows.groupBy("game_id", "category").agg(F.sum("w").alias("w"))


def content_scores(pairs: DataFrame, shares: DataFrame, games: DataFrame) -> DataFrame:
    """Content score of given (user_id, game_id) pairs; work is linear in the pairs.

    A pair meets its game's tags and its user's shares as one list each, so no row is
    multiplied by the tags; the lists are bounded by the tags.
    """
    weighed = F.collect_list(F.struct("category", "w")).alias("tags")
    tags = _tag_weights(games).groupBy("game_id").agg(weighed)
    known = shares.where("user_id IS NOT NULL AND category IS NOT NULL AND weight IS NOT NULL")
    users = known.groupBy("user_id").agg(F.collect_list(F.struct("category", "weight")).alias("p"))
    users = users.select("user_id", _share_map(F.col("p")).alias("shares"))
    met = pairs.select("user_id", "game_id").join(tags, "game_id", "left").join(users, "user_id", "left")
    parts = F.filter(
        F.transform("tags", lambda t: F.try_element_at("shares", t["category"]) * t["w"]), lambda x: x.isNotNull()
    )
    raw = F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0.0), lambda total, x: total + x))
    score = F.coalesce(F.sum("raw"), F.lit(0.0)).alias("predicted_score")
    return met.select("user_id", "game_id", raw.alias("raw")).groupBy("user_id", "game_id").agg(score)


def _share_map(entries: Column) -> Column:
    """Category to share; the shares of a repeated category are added up."""
    names = F.array_distinct(entries["category"])

    def total(name: Column) -> Column:
        own = F.filter(entries, lambda e: e["category"] == name)
        return F.aggregate(own, F.lit(0.0), lambda so_far, e: so_far + e["weight"])

    added = F.map_from_arrays(names, F.transform(names, total))
    return F.when(F.size(names) == F.size(entries), F.map_from_entries(entries)).otherwise(added)


def predict_for_user(user_id, shares: DataFrame, games: DataFrame) -> DataFrame:
    """Content score of every game for one user."""
    own = shares.filter(F.col("user_id") == user_id)
    pairs = games.select(F.lit(user_id).alias("user_id"), "game_id")
    return content_scores(pairs, own, games)


@dataclass(frozen=True)
class ItemBlock:
    """Tag postings of one set of games, in game id order."""

    game_ids: np.ndarray
    categories: pa.Array
    offsets: np.ndarray
    items: np.ndarray
    weights: np.ndarray

    @staticmethod
    def build(table: pa.Table) -> "ItemBlock":
        """From rows (game_id, category, w); a null category marks an untagged game."""
        game_ids = np.unique(table["game_id"].to_numpy())
        table = table.filter(pc.is_valid(table["category"])).sort_by("category")
        coded = table["category"].combine_chunks().dictionary_encode()
        counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        return ItemBlock(
            game_ids,
            coded.dictionary,
            np.concatenate([[0], np.cumsum(counts)]).astype("int64"),
            np.searchsorted(game_ids, table["game_id"].to_numpy()),
            table["w"].to_numpy(),
        )

    def top(self, codes: np.ndarray, shares: np.ndarray, owned: np.ndarray, k: int):
        """Best ``k`` games that are not owned: (game ids, scores), ties by id."""
        runs = [np.arange(self.offsets[c], self.offsets[c + 1]) for c in codes]
        at = np.concatenate(runs) if runs else np.empty(0, "int64")
        each = np.repeat(shares, [len(r) for r in runs]) if runs else np.empty(0)
        raw = np.bincount(self.items[at], each * self.weights[at], minlength=len(self.game_ids))
        scores = np.floor(raw * 10**DECIMALS + 0.5) / 10**DECIMALS
        place = np.searchsorted(self.game_ids, owned)
        place = place[place < len(self.game_ids)]
        free = np.ones(len(self.game_ids), bool)
        free[place[np.isin(self.game_ids[place], owned)]] = False
        open_items = np.flatnonzero(free)
        if len(open_items) > k:
            cut = np.partition(scores[open_items], len(open_items) - k)[len(open_items) - k]
            open_items = open_items[scores[open_items] >= cut]
        best = open_items[np.argsort(-scores[open_items], kind="stable")][:k]
        return self.game_ids[best], scores[best]

    def rank_users(self, users: pa.Table, k: int) -> pa.Table:
        """Best games of every user: rows with tags, shares and owned games."""
        tags, tag_ends = _flat(users["categories"])
        shares, _ = _flat(users["shares"])
        owned, owned_ends = _flat(users["owned"])
        codes = pc.fill_null(pc.index_in(tags, value_set=self.categories), -1).to_numpy()
        shares, owned = shares.to_numpy(), owned.to_numpy()
        games, scores = [np.empty(0, "int64")], [np.empty(0)]
        for i in range(users.num_rows):
            mine = slice(tag_ends[i], tag_ends[i + 1])
            known = codes[mine] >= 0
            library = owned[owned_ends[i] : owned_ends[i + 1]]
            found, score = self.top(codes[mine][known], shares[mine][known], library, k)
            games.append(found)
            scores.append(score)
        counts = [len(g) for g in games[1:]]
        return pa.table(
            {
                "user_id": pa.array(np.repeat(users["user_id"].to_numpy(), counts)),
                "game_id": pa.array(np.concatenate(games)),
                "predicted_score": pa.array(np.concatenate(scores)),
            }
        )


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All items of a list column and the offsets of its rows."""
    whole = lists.combine_chunks()
    sizes = pc.list_value_length(whole).to_numpy(zero_copy_only=False)
    return whole.flatten(), np.concatenate([[0], np.cumsum(sizes)]).astype("int64")


def top_content_items(
    shares: DataFrame, owned: DataFrame, games: DataFrame, k: int, item_rows: int = ITEM_ROWS
) -> DataFrame:
    """Exact best ``k`` unowned games per user by content score.

    Users are those of ``shares`` or ``owned``; their tag lists are bounded by the tags.
    """
    part = F.when(F.col("user_id").isNotNull(), F.struct("category", "weight")).alias("p")
    rows = shares.select("user_id", part)
    # A struct of a user without tags is null, which the list leaves out.
    rows = rows.union(owned.select("user_id").distinct().select("user_id", F.lit(None).cast(rows.schema["p"].dataType)))
    users = rows.groupBy("user_id").agg(F.collect_list("p").alias("p")).select(
        "user_id", F.col("p.category").alias("categories"), F.col("p.weight").alias("shares")
    )
    items = games.select("game_id").join(_tag_weights(games), "game_id", "left")
    return block_top_k(users, items, owned, k, ItemBlock.build, item_rows=item_rows)


def top_vector_items(
    user_vectors: DataFrame, item_vectors: DataFrame, owned: DataFrame, games: DataFrame, k: int,
    item_rows: int = ITEM_ROWS,
) -> DataFrame:
    """Exact best ``k`` unowned games per user by inner product.

    Users and games that the model has not seen get a zero vector: such a user's games, and
    such a game for all, score 0.
    """
    size = item_vectors.select(F.size("vector")).first()
    none = F.array_repeat(F.lit(0.0), size[0] if size else 1)
    everyone = user_vectors.select("user_id").union(owned.select("user_id")).distinct()
    users = everyone.join(user_vectors, "user_id", "left").select("user_id", F.coalesce("vector", none).alias("vector"))
    items = games.select("game_id").distinct().join(item_vectors, "game_id", "left")
    items = items.select("game_id", F.coalesce("vector", none).alias("vector"))
    return block_top_k(users, items, owned, k, VectorBlock, item_rows=item_rows)


SCORERS = ("content", "als", "fm")


def recommend(
    tags: DataFrame,
    playtimes: DataFrame,
    games: DataFrame,
    reviews: DataFrame,
    k: int = K.TOP_N,
    threshold: float = K.SCORE_THRESHOLD,
    scorer: str = "content",
    item_rows: int = ITEM_ROWS,
    **training,
) -> DataFrame:
    """Top ``k`` unowned games above the score threshold for every user.

    ``scorer`` is ``content``, ``als`` (implicit factorisation) or ``fm`` (factors of the
    users' and games' features); the trained ones are fitted on the playtimes of all scored
    games, with ``training`` as options. Filtering by threshold and ownership comes before
    the ranking, which leaves the same first ``k`` as filtering a full ranking. Gives
    (user_id, position, game_id, app_name, predicted_score, normalized_score).
    """
    if scorer not in SCORERS:
        raise ValueError(f"scorer must be one of {SCORERS}, not {scorer!r}")
    rankable = games.filter(F.col("normalized_score") > F.lit(float(threshold)))
    playtimes = stage(playtimes.select("user_id", "game_id", "playtime_forever"), "playtimes")
    owned = playtimes.select("user_id", "game_id").where("user_id IS NOT NULL")
    shares = user_features(user_category_profile(tags, playtimes))
    if scorer == "content":
        best = top_content_items(shares, owned, rankable, k, item_rows)
    else:
        pairs = stage(interactions(playtimes, games), "interactions")
        if scorer == "als":
            users, items = als_vectors(*train_als(pairs, **training))
        else:
            fitted = train_hybrid(pairs, stage(shares, "shares"), games, **training)
            users, items = fitted.users, fitted.items
        best = top_vector_items(users, items, owned, rankable, k, item_rows)
    return describe_recommendations(best, rankable, reviews)


def describe_recommendations(best: DataFrame, games: DataFrame, reviews: DataFrame) -> DataFrame:
    """Attach names and scores to ranked pairs and number them 0..k-1."""
    facts = join_names(games.select("game_id", "normalized_score"), reviews)
    named = best.join(facts, "game_id", "inner")
    numbered = rank_reset(named, ["user_id"], [F.desc("predicted_score"), F.col("game_id")])
    return numbered.select(
        "user_id", "position", "game_id", "app_name", "predicted_score", "normalized_score"
    )


def train_als(
    pairs: DataFrame, rank: int = 10, max_iter: int = 10, seed: int = K.SPLIT_SEED
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Implicit-feedback factorisation with playtime as confidence.

    ALS wants 32-bit ids, so users and games are indexed first. Returns the model
    and both index tables.
    """
    users = index_entities(pairs, "user_id")
    games = index_entities(pairs, "game_id")
    indexed = (
        pairs.join(users.withColumnRenamed("idx", "u"), "user_id")
        .join(games.withColumnRenamed("idx", "g"), "game_id")
        .select(F.col("u").cast("int"), F.col("g").cast("int"), F.col("weight").cast("float"))
    )
    als = ALS(
        userCol="u", itemCol="g", ratingCol="weight", implicitPrefs=True,
        rank=rank, maxIter=max_iter, seed=seed,
    )
    return als.fit(indexed), users, games


def als_vectors(model: ALSModel, users: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(user_id, vector) and (game_id, vector) of a fitted model and its two indexes."""

    def named(factors: DataFrame, index: DataFrame, key: str) -> DataFrame:
        rows = factors.join(index.select(key, F.col("idx").cast("int").alias("id")), "id")
        return rows.select(key, F.col("features").cast("array<double>").alias("vector"))

    return named(model.userFactors, users, "user_id"), named(model.itemFactors, games, "game_id")


def recommend_als(model: ALSModel, users: DataFrame, games: DataFrame, k: int) -> DataFrame:
    """Best ``k`` games per user (blocked in MLlib), as (user_id, game_id, score)."""
    ranked = model.recommendForAllUsers(k).select("u", F.inline("recommendations"))
    return (
        ranked.join(users.select("user_id", F.col("idx").cast("int").alias("u")), "u")
        .join(games.select("game_id", F.col("idx").cast("int").alias("g")), "g")
        .select("user_id", "game_id", F.col("rating").cast("double").alias("predicted_score"))
    )
