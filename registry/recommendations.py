"""Profiles, features, content scores, trained recommenders, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from registry.inputs import rounded, table, tag_lists, with_inputs
from tastegraph import constants as K
from tastegraph.operators import recommender, scoring
from tastegraph.session import stage

FIRST_USER = 10_000_000_000_000_000
# The derived games score lower than real ones, so the cut is lower too.
THRESHOLD = 0.5


def _games(spark, sf):
    scores = scoring.game_score(scoring.weigh_reviews(table(spark, sf, "scored_reviews")))
    return scoring.game_features(scores, table(spark, sf, "reviews"), tag_lists(spark, sf))


def _shares(spark, sf, played=None):
    played = table(spark, sf, "playtimes") if played is None else played
    return recommender.user_features(recommender.user_category_profile(tag_lists(spark, sf), played))


def index_entities(spark, sf):
    played = table(spark, sf, "playtimes")
    users = recommender.index_entities(played, "user_id").select(
        F.lit("user").alias("kind"), F.col("user_id").alias("entity"), "idx"
    )
    games = recommender.index_entities(_games(spark, sf), "game_id").select(
        F.lit("game").alias("kind"), F.col("game_id").alias("entity"), "idx"
    )
    return users.unionByName(games)


def item_features(spark, sf):
    return rounded(recommender.item_features(_games(spark, sf)), "weight")


def user_category_profile(spark, sf):
    return recommender.user_category_profile(tag_lists(spark, sf), table(spark, sf, "playtimes"))


def user_features(spark, sf):
    return rounded(_shares(spark, sf), "weight", digits=12)


def interactions(spark, sf):
    return recommender.interactions(table(spark, sf, "playtimes"), _games(spark, sf))


def content_scores(spark, sf):
    """Scores of every observed (user, game) pair."""
    games, played = stage(_games(spark, sf), "games"), stage(table(spark, sf, "playtimes"), "played")
    pairs = recommender.interactions(played, games)
    scores = recommender.content_scores(pairs, _shares(spark, sf, played), games)
    return rounded(scores, "predicted_score", digits=recommender.DECIMALS)


def predict_scores(spark, sf):
    """Scores of every game for one user."""
    scores = recommender.predict_for_user(FIRST_USER, _shares(spark, sf), _games(spark, sf))
    return rounded(scores, "predicted_score", digits=recommender.DECIMALS)


def recommend(spark, sf):
    games = stage(_games(spark, sf), "games")
    best = recommender.recommend(
        tag_lists(spark, sf), table(spark, sf, "playtimes"), games,
        table(spark, sf, "reviews"), K.TOP_N, THRESHOLD,
    )
    return rounded(best, "normalized_score")


def recommend_blocked(spark, sf):
    """The same with a catalogue cut into many blocks."""
    games = stage(_games(spark, sf), "games")
    best = recommender.recommend(
        tag_lists(spark, sf), table(spark, sf, "playtimes"), games,
        table(spark, sf, "reviews"), K.TOP_N, THRESHOLD, item_rows=2_000,
    )
    return rounded(best, "normalized_score")


def _by_model(scorer):
    """What any scorer must give each user: as many games as there are, in order, none
    owned, all above the cut."""

    def run(spark, sf):
        games, played = stage(_games(spark, sf), "games"), stage(table(spark, sf, "playtimes"), "played")
        best = recommender.recommend(
            tag_lists(spark, sf), played, games, table(spark, sf, "reviews"), K.TOP_N, THRESHOLD, scorer=scorer
        )
        owned = played.select("user_id", "game_id", F.lit(1).alias("owned"))
        marked = stage(best, "best").join(owned, ["user_id", "game_id"], "left")
        before = F.lag("predicted_score").over(Window.partitionBy("user_id").orderBy("position"))
        marked = marked.withColumn("falls", F.coalesce(before >= F.col("predicted_score"), F.lit(True)))
        return marked.groupBy("user_id").agg(
            F.count_distinct("game_id").alias("games"),
            F.max("position").cast("long").alias("last_position"),
            F.count("owned").alias("owned"),
            F.min((F.col("normalized_score") > THRESHOLD).cast("int")).alias("above_cut"),
            F.min(F.col("falls").cast("int")).alias("in_order"),
        )

    return run


def train_als(spark, sf):
    pairs = stage(interactions(spark, sf), "interactions")
    model, users, games = recommender.train_als(pairs)
    return recommender.recommend_als(model, users, games, K.TOP_N)


def train_hybrid(spark, sf):
    """Fit the feature factorisation and score every observed pair."""
    games = stage(_games(spark, sf), "games")
    played = stage(table(spark, sf, "playtimes"), "played")
    shares = stage(_shares(spark, sf, played), "shares")
    pairs = stage(recommender.interactions(played, games), "interactions")
    return recommender.train_hybrid(pairs, shares, games).predict(pairs)


PAIR_SCORE = """
SELECT i.user_id, i.game_id, ROUND(COALESCE(SUM(s.weight * w.w), 0e0), 12) AS predicted_score
FROM {pairs} i LEFT JOIN tag_weights w ON i.game_id = w.game_id
LEFT JOIN shares s ON s.user_id = i.user_id AND s.category = w.category
GROUP BY i.user_id, i.game_id
"""
PLAYED_GAMES = (
    "SELECT p.user_id, p.game_id, p.playtime_forever FROM playtimes p JOIN games g ON p.game_id = g.game_id"
)
USER_GAMES = f"SELECT CAST({FIRST_USER} AS BIGINT) AS user_id, game_id FROM games"
# Every user with every unowned game above the cut; only the check pairs them all.
OPEN_PAIRS = f"""
SELECT u.user_id, g.game_id FROM (SELECT DISTINCT user_id FROM playtimes) u
CROSS JOIN (SELECT game_id FROM games WHERE normalized_score > {THRESHOLD}) g
WHERE NOT EXISTS (SELECT 1 FROM playtimes p WHERE p.user_id = u.user_id AND p.game_id = g.game_id)
"""
RECOMMENDED = f"""
SELECT b.user_id, CAST(b.rank - 1 AS INTEGER) AS position, b.game_id, n.app_name, b.predicted_score,
       ROUND(g.normalized_score, 6) AS normalized_score
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted_score DESC, game_id) AS rank
      FROM open_scores) b
JOIN games g ON b.game_id = g.game_id
LEFT JOIN (SELECT app_id, arg_min(app_name, review_id) AS app_name FROM reviews
           WHERE app_name IS NOT NULL GROUP BY app_id) n ON n.app_id = b.game_id
WHERE b.rank <= {K.TOP_N}
"""
# Of a model's ranking SQL can tell all but the order of the games.
LISTED = f"""
SELECT user_id, LEAST(COUNT(*), {K.TOP_N}) AS games, LEAST(COUNT(*), {K.TOP_N}) - 1 AS last_position,
       CAST(0 AS BIGINT) AS owned, 1 AS above_cut, 1 AS in_order
FROM open_pairs GROUP BY user_id
"""
RECOMMEND_SQL = with_inputs(
    RECOMMENDED, open_pairs=OPEN_PAIRS, open_scores=PAIR_SCORE.format(pairs="open_pairs")
)

QUERIES = {
    "index_entities": (
        index_entities,
        with_inputs(
            "SELECT 'user' AS kind, user_id AS entity, row_number() OVER (ORDER BY user_id) - 1 AS idx "
            "FROM (SELECT DISTINCT user_id FROM playtimes) UNION ALL "
            "SELECT 'game', game_id, row_number() OVER (ORDER BY game_id) - 1 FROM games"
        ),
    ),
    "item_features": (
        item_features,
        with_inputs(
            """SELECT game_id, 'tag:' || category AS feature, ROUND(w, 6) AS weight FROM tag_weights
            UNION ALL SELECT t.game_id, 'game:' || t.game_id, ROUND(1e0 / (1e0 + COUNT(*)), 6)
            FROM game_tags t JOIN games g ON t.game_id = g.game_id GROUP BY t.game_id"""
        ),
    ),
    "user_category_profile": (user_category_profile, with_inputs("SELECT * FROM profile")),
    "user_features": (
        user_features,
        with_inputs("SELECT user_id, category, ROUND(weight, 12) AS weight FROM shares"),
    ),
    "interactions": (
        interactions,
        with_inputs("SELECT user_id, game_id, playtime_forever AS weight FROM played", played=PLAYED_GAMES),
    ),
    "content_scores": (
        content_scores,
        with_inputs(PAIR_SCORE.format(pairs="played"), played=PLAYED_GAMES),
    ),
    "predict_scores": (
        predict_scores,
        with_inputs(PAIR_SCORE.format(pairs="user_games"), user_games=USER_GAMES),
    ),
    "recommend": (recommend, RECOMMEND_SQL),
    "recommend_blocked": (recommend_blocked, RECOMMEND_SQL),
    "recommend_als": (_by_model("als"), with_inputs(LISTED, open_pairs=OPEN_PAIRS)),
    "recommend_fm": (_by_model("fm"), with_inputs(LISTED, open_pairs=OPEN_PAIRS)),
    "train_als": (train_als, None),
    "train_hybrid": (train_hybrid, None),
}
