"""Nested data, joins, graph edges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.inputs import given, library_part, rounded, table, tag_lists, with_inputs
from tastegraph.operators import graph, joins, nested, ranking, scoring


def collect_review_texts(spark, sf):
    chunks = nested.collect_review_texts(table(spark, sf, "reviews"), chunk=20)
    texts = F.md5(F.array_join("texts", "|")).alias("texts_md5")
    return chunks.select("app_id", "chunk", F.size("texts").cast("long").alias("n"), texts)


def _nested_tags(spark, sf):
    lists = nested.transpose_tags_nested(table(spark, sf, "tag_cells"))
    return lists.withColumnRenamed("app_id", "game_id")


def explode_tags_outer(spark, sf):
    return nested.explode_tags_outer(_nested_tags(spark, sf))


def explode_tags_stream(spark, sf):
    return nested.explode_tags(_nested_tags(spark, sf).withColumnRenamed("game_id", "app_id"))


def _documents(spark, sf):
    """Owned-games documents in arrival order."""
    rows = table(spark, sf, "library").select(
        "user_id",
        library_part("app_id"),
        F.struct(
            "place",
            F.col("app_id").cast("string").alias("appid"),
            "playtime_forever",
            "playtime_windows_forever",
        ).alias("g"),
    )
    lists = rows.groupBy("user_id", "part").agg(F.array_sort(F.collect_list("g")).alias("games"))
    missing = F.lit(None).cast("double")
    game = lambda g: F.struct(
        g["appid"].alias("appid"),
        g["playtime_forever"].alias("playtime_forever"),
        g["playtime_windows_forever"].alias("playtime_windows_forever"),
        missing.alias("playtime_mac_forever"),
        missing.alias("playtime_linux_forever"),
        missing.alias("rtime_last_played"),
        missing.alias("playtime_disconnected"),
    )
    return lists.select("user_id", F.transform("games", game).alias("games"))


def explode_user_games(spark, sf):
    rows = nested.explode_user_games(_documents(spark, sf))
    return rows.select("user_id", "app_id", "playtime_forever", "playtime_windows_forever")


def playtime_map(spark, sf):
    maps = _documents(spark, sf).select("user_id", nested.playtime_map(F.col("games")).alias("m"))
    return maps.select("user_id", F.explode("m").alias("app_id", "playtime_forever"))


PROPS = T.StructType([T.StructField("k", T.IntegerType())])
# Events of one type carry a broken record.
MESSAGES = "SELECT event_id, CASE WHEN event_type = 'click' THEN substr(props, 2) ELSE props END AS value FROM events"


def _messages(spark, sf):
    broken = F.when(F.col("event_type") == "click", F.expr("substr(props, 2)"))
    return given(spark, sf, "events").select("event_id", broken.otherwise(F.col("props")).alias("value"))


def parse_json_records(spark, sf):
    parsed = nested.parse_json_records(_messages(spark, sf), PROPS)
    return parsed.select("event_id", F.col("json.k").alias("k"))


def flatten_struct(spark, sf):
    return nested.flatten_struct(nested.parse_json_records(_messages(spark, sf), PROPS))


JSON_SQL = (
    "CASE WHEN json_valid(value) THEN CAST(json_extract_string(value, '$.k') AS INTEGER) END AS k "
    f"FROM ({MESSAGES})"
)


def _scores(spark, sf):
    return scoring.game_score(scoring.weigh_reviews(table(spark, sf, "scored_reviews")))


def _games(spark, sf):
    return scoring.game_features(
        _scores(spark, sf), table(spark, sf, "reviews"), tag_lists(spark, sf)
    )


def join_scores_counts(spark, sf):
    counts = scoring.occurrences(table(spark, sf, "reviews"))
    return rounded(joins.join_scores_counts(_scores(spark, sf), counts), "score")


def join_scores_tags(spark, sf):
    joined = joins.join_scores_tags(_scores(spark, sf), tag_lists(spark, sf))
    return rounded(joined.withColumn("categories", F.array_join("categories", "|")), "score")


def join_tags_playtime(spark, sf):
    joined = joins.join_tags_playtime(tag_lists(spark, sf), table(spark, sf, "playtimes"))
    return joined.withColumn("categories", F.array_join("categories", "|"))


def join_interactions(spark, sf):
    joined = joins.join_interactions(table(spark, sf, "playtimes"), _games(spark, sf))
    return rounded(joined, "normalized_score", "score")


def join_names(spark, sf):
    return rounded(joins.join_names(_scores(spark, sf), table(spark, sf, "reviews")), "score")


CANDIDATES = """
SELECT DISTINCT 10000000000000000 + o.o_custkey AS user_id, l.l_suppkey AS game_id
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""


def exclude_owned(spark, sf):
    orders, lines = given(spark, sf, "orders"), given(spark, sf, "lineitem")
    candidates = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .select(
            (F.lit(10_000_000_000_000_000) + F.col("o_custkey")).alias("user_id"),
            F.col("l_suppkey").alias("game_id"),
        )
        .distinct()
    )
    return joins.exclude_owned(candidates, table(spark, sf, "playtimes"))


def union_all_frames(spark, sf):
    tags = table(spark, sf, "game_tags").select("game_id", "category")
    brands = table(spark, sf, "wide_cells").select("category", F.col("app_id").alias("game_id"))
    return joins.union_all_frames([tags, brands])


FIRST_USER = 10_000_000_000_000_000


def join_user_key_filter(spark, sf):
    return joins.owned_games(table(spark, sf, "playtimes"), FIRST_USER)


def _game_nodes(spark, sf):
    named = table(spark, sf, "reviews").filter(F.col("app_name").isNotNull())
    return graph.merge_nodes(
        named.select("app_id", "app_name", "review_id"), ["app_id"], [F.desc("review_id")]
    )


def sink_nodes(spark, sf):
    return _game_nodes(spark, sf)


GAME_NODES = (
    "SELECT app_id, app_name, review_id FROM reviews WHERE app_name IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY review_id DESC) = 1"
)
GAME_IDS = "app_id IN (SELECT app_id FROM reviews WHERE app_name IS NOT NULL)"


def edges_review_game(spark, sf):
    reviews = table(spark, sf, "repeated_reviews").withColumnRenamed("review_id", "id")
    return graph.edges_review_game(reviews, _game_nodes(spark, sf))


def edges_tag_game(spark, sf):
    tags = table(spark, sf, "game_tags").withColumnRenamed("game_id", "app_id")
    return graph.edges_tag_game(tags, _game_nodes(spark, sf))


def edges_user_game(spark, sf):
    return graph.edges_user_game(table(spark, sf, "library"), _game_nodes(spark, sf))


QUERIES = {
    "collect_review_texts": (
        collect_review_texts,
        with_inputs(
            """SELECT app_id, chunk, COUNT(*) AS n,
            md5(string_agg(review_text, '|' ORDER BY review_id)) AS texts_md5
            FROM (SELECT *, (row_number() OVER (PARTITION BY app_id ORDER BY review_id) - 1) // 20 AS chunk
                  FROM reviews) GROUP BY app_id, chunk"""
        ),
    ),
    "explode_tags_outer": (
        explode_tags_outer,
        with_inputs(
            "SELECT game_id, category AS categories FROM game_tags UNION ALL "
            "SELECT app_id, NULL FROM tag_cells GROUP BY app_id HAVING COUNT(category) = 0"
        ),
    ),
    "explode_tags_stream": (
        explode_tags_stream,
        with_inputs("SELECT game_id AS app_id, category FROM game_tags"),
    ),
    "explode_user_games": (
        explode_user_games,
        with_inputs(
            "SELECT user_id, CAST(app_id AS VARCHAR) AS app_id, playtime_forever, "
            "playtime_windows_forever FROM library"
        ),
    ),
    "playtime_map": (
        playtime_map,
        with_inputs(
            "SELECT user_id, CAST(app_id AS VARCHAR) AS app_id, playtime_forever FROM library "
            "QUALIFY row_number() OVER (PARTITION BY user_id, app_id "
            "ORDER BY place DESC, playtime_forever DESC) = 1"
        ),
    ),
    "parse_json_records": (parse_json_records, f"SELECT event_id, {JSON_SQL}"),
    "flatten_struct": (flatten_struct, f"SELECT {JSON_SQL}"),
    "join_scores_counts": (
        join_scores_counts,
        with_inputs(
            "SELECT s.game_id, ROUND(s.score, 6) AS score, o.occurrence FROM scores s "
            "LEFT JOIN occurrences o ON s.game_id = o.game_id"
        ),
    ),
    "join_scores_tags": (
        join_scores_tags,
        with_inputs(
            "SELECT s.game_id, ROUND(MAX(s.score), 6) AS score, "
            "string_agg(t.category, '|' ORDER BY t.pos) AS categories "
            "FROM scores s JOIN game_tags t ON s.game_id = t.game_id GROUP BY s.game_id"
        ),
    ),
    "join_tags_playtime": (
        join_tags_playtime,
        with_inputs(
            """SELECT p.game_id, t.categories, p.user_id, p.playtime_forever FROM playtimes p
            LEFT JOIN (SELECT game_id, string_agg(category, '|' ORDER BY pos) AS categories
                       FROM game_tags GROUP BY game_id) t ON p.game_id = t.game_id"""
        ),
    ),
    "join_interactions": (
        join_interactions,
        with_inputs(
            "SELECT p.game_id, p.user_id, p.playtime_forever, "
            "ROUND(g.normalized_score, 6) AS normalized_score, ROUND(g.score, 6) AS score "
            "FROM playtimes p JOIN games g ON p.game_id = g.game_id"
        ),
    ),
    "join_names": (
        join_names,
        with_inputs(
            """SELECT s.game_id, ROUND(s.score, 6) AS score, n.app_name FROM scores s LEFT JOIN
            (SELECT app_id, arg_min(app_name, review_id) AS app_name FROM reviews
             WHERE app_name IS NOT NULL GROUP BY app_id) n ON s.game_id = n.app_id"""
        ),
    ),
    "exclude_owned": (
        exclude_owned,
        with_inputs(
            "SELECT user_id, game_id FROM candidates EXCEPT SELECT user_id, game_id FROM playtimes",
            candidates=CANDIDATES,
        ),
    ),
    "union_all_frames": (
        union_all_frames,
        with_inputs(
            "SELECT game_id, category FROM game_tags UNION ALL SELECT app_id, category FROM wide_cells"
        ),
    ),
    "join_user_key_filter": (
        join_user_key_filter,
        with_inputs(f"SELECT game_id FROM playtimes WHERE user_id = {FIRST_USER}"),
    ),
    "sink_nodes": (sink_nodes, with_inputs(GAME_NODES)),
    "edges_review_game": (
        edges_review_game,
        with_inputs(
            f"SELECT DISTINCT review_id AS id, app_id FROM repeated_reviews WHERE {GAME_IDS}"
        ),
    ),
    "edges_tag_game": (
        edges_tag_game,
        with_inputs(
            f"SELECT DISTINCT app_id, category FROM (SELECT game_id AS app_id, category FROM game_tags) WHERE {GAME_IDS}"
        ),
    ),
    "edges_user_game": (
        edges_user_game,
        with_inputs(f"SELECT DISTINCT user_id, app_id FROM library WHERE {GAME_IDS}"),
    ),
}
