"""Scans, sinks, projections, filters, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.inputs import BRANDS, given, library_part, rounded, table, tag_lists, with_inputs
from tastegraph import schemas
from tastegraph.operators import cleaning, nested, profiling, ranking, scoring
from tastegraph.session import fresh_path
from tastegraph.sources import batch, topics

FOUR = ["app_id", "app_name", "review_score", "review_text"]
FIVE = [*FOUR, "review_votes"]


def _reviews(spark, sf):
    return table(spark, sf, "reviews")


def scan_reviews(spark, sf):
    path = fresh_path(spark, "reviews-csv")
    batch.sink_csv(_reviews(spark, sf).select(schemas.REVIEW_TABLE.names), path)
    return batch.scan_reviews(spark, path)


def scan_reviews_capped(spark, sf):
    return batch.scan_reviews_capped(_reviews(spark, sf), [F.col("review_id")], 500)


def _wide(spark, sf):
    cells = table(spark, sf, "wide_cells")
    path = fresh_path(spark, "tags-csv")
    wide = nested.pivot_tags_wide(cells, BRANDS).withColumn("0", F.lit(None).cast("string"))
    batch.sink_csv(wide, path)
    return batch.scan_tags_wide(spark, path)


def scan_tags_wide(spark, sf):
    return _wide(spark, sf).withColumn("pos", F.col("pos").cast("long")).drop("0")


WIDE_SQL = with_inputs(
    "SELECT pos, "
    + ", ".join(f"MAX(CASE WHEN app_id = {b} THEN category END) AS \"{b}\"" for b in BRANDS)
    + " FROM wide_cells GROUP BY pos"
)


def pivot_tags_wide(spark, sf):
    return nested.pivot_tags_wide(table(spark, sf, "wide_cells"), BRANDS)


def unpivot_tags(spark, sf):
    return nested.unpivot_tags(_wide(spark, sf).drop("pos"))


def transpose_tags_nested(spark, sf):
    lists = nested.transpose_tags_nested(table(spark, sf, "tag_cells"))
    joined = F.array_join("categories", "|").alias("categories")
    return lists.select("app_id", F.size("categories").cast("long").alias("n"), joined)


def scan_scores(spark, sf):
    path = fresh_path(spark, "scores-csv")
    batch.sink_csv(scoring.game_score(scoring.weigh_reviews(table(spark, sf, "scored_reviews"))), path)
    return rounded(batch.scan_scores(spark, path), "score")


def ingest_owned_games(spark, sf):
    library = table(spark, sf, "playtimes")
    totals = library.groupBy("user_id").agg(F.sum("playtime_forever").alias("total"))
    game = F.struct(F.col("game_id").cast("string").alias("appid"), "playtime_forever").alias("g")
    lists = library.select("user_id", library_part("game_id"), game).groupBy("user_id", "part")
    answers = lists.agg(F.collect_list("g").alias("games")).join(totals, "user_id")
    answers = answers.select(
        "user_id",
        F.when(F.col("total") >= 500, 200).otherwise(503).alias("status"),
        F.struct("games").alias("response"),
    )
    idle = given(spark, sf, "customer").select(
        (F.lit(10_000_000_000_000_000) + F.col("c_custkey")).alias("user_id"),
        F.lit(200).alias("status"),
        F.expr("named_struct('games', CAST(array() AS array<struct<appid:string,playtime_forever:double>>))").alias("response"),
    )
    path = fresh_path(spark, "owned-games")
    answers.unionByName(idle).write.json(path)
    games = nested.explode_user_games(batch.ingest_owned_games(spark, path))
    return games.select("user_id", "app_id", "playtime_forever")


INGEST_SQL = with_inputs(
    """SELECT p.user_id, CAST(p.game_id AS VARCHAR) AS app_id, p.playtime_forever FROM playtimes p
    JOIN (SELECT user_id FROM playtimes GROUP BY user_id HAVING SUM(playtime_forever) >= 500) g
    ON p.user_id = g.user_id"""
)

LINK_PATTERN = r'href="(/([^"/?#]+))"'


def tags_from_pages(spark, sf):
    tagged = nested.tags_from_pages(given(spark, sf, "pages"), LINK_PATTERN)
    return tagged.select(
        "page_id",
        F.size("categories").cast("long").alias("n"),
        F.array_join("categories", "|").alias("categories"),
    )


PAGES_SQL = rf"""
SELECT page_id, CAST(len(tags) AS BIGINT) AS n, array_to_string(tags, '|') AS categories
FROM (SELECT page_id, list_transform(regexp_extract_all(html, '{LINK_PATTERN}', 2),
                                     lambda s: url_decode(s)) AS tags FROM pages)
"""


def sink_json_topic(spark, sf):
    path = fresh_path(spark, "topic")
    rows = _reviews(spark, sf).select("review_id", *FIVE)
    topics.sink_json_files(rows, path, "reviews", "review_id")
    messages = spark.read.schema(schemas.TOPIC_RECORD).json(path)
    return messages.select(F.from_json("value", rows.schema).alias("json")).select("json.*")


FOUR_SQL = ", ".join(FOUR)


def sample_exact_n(spark, sf):
    return ranking.sample_exact_n(_reviews(spark, sf), F.col("review_id"), 500, 34)


def assign_row_id(spark, sf):
    rows = _reviews(spark, sf).select("review_id", "app_id")
    return ranking.assign_row_id(rows, [-F.col("app_id"), F.col("review_id")], "id", ranges=16)


def positional_lookup(spark, sf):
    positions = _reviews(spark, sf).select(F.col("app_id").alias("id"))
    return cleaning.positional_lookup(assign_row_id(spark, sf), positions)


ROW_ID = "SELECT review_id, app_id, row_number() OVER (ORDER BY app_id DESC, review_id) - 1 AS id FROM reviews"


def cast_key(spark, sf):
    mixed = given(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.col("p_partkey").cast("string")).alias("game_id"),
    )
    return cleaning.cast_key(mixed, "game_id")


def prune_null_items(spark, sf):
    cells = table(spark, sf, "tag_cells").groupBy("app_id").pivot("pos", [0, 1, 2]).agg(F.first("category"))
    kept = cleaning.prune_null_items(F.array("0", "1", "2"))
    return cells.select("app_id", F.array_join(kept, "|").alias("categories"))


def clean_reviews(spark, sf):
    return cleaning.clean_reviews(_reviews(spark, sf), n=300)


def filter_threshold(spark, sf):
    normalized = table(spark, sf, "normalized")
    return rounded(cleaning.filter_threshold(normalized, 2.0), "score", "normalized_score")


def table_profile(spark, sf):
    return profiling.table_profile(_reviews(spark, sf))


TYPES = {"review_id": "bigint", "app_id": "bigint", "app_name": "string", "review_text": "string",
         "review_score": "int", "review_votes": "int"}

QUERIES = {
    "scan_reviews": (
        scan_reviews,
        with_inputs("SELECT app_id, app_name, review_text, review_score, review_votes FROM reviews"),
    ),
    "scan_reviews_capped": (
        scan_reviews_capped,
        with_inputs("SELECT * FROM reviews ORDER BY review_id LIMIT 500"),
    ),
    "scan_tags_wide": (scan_tags_wide, WIDE_SQL),
    "scan_scores": (
        scan_scores,
        with_inputs("SELECT game_id, ROUND(score, 6) AS score FROM scores"),
    ),
    "ingest_owned_games": (ingest_owned_games, INGEST_SQL),
    "tags_from_pages": (tags_from_pages, PAGES_SQL),
    "sink_json_topic": (sink_json_topic, with_inputs(f"SELECT review_id, {', '.join(FIVE)} FROM reviews")),
    "project_columns": (
        lambda s, sf: cleaning.project_columns(_reviews(s, sf), FOUR),
        with_inputs(f"SELECT {FOUR_SQL} FROM reviews"),
    ),
    "rename_columns": (
        lambda s, sf: cleaning.rename_columns(
            _reviews(s, sf).select(*FOUR), {"review_score": "target", "review_text": "text"}
        ),
        with_inputs(
            "SELECT app_id, app_name, review_score AS target, review_text AS text FROM reviews"
        ),
    ),
    "drop_null_rows": (
        lambda s, sf: cleaning.drop_null_rows(_reviews(s, sf), FOUR),
        with_inputs("SELECT * FROM reviews WHERE app_name IS NOT NULL AND review_score IS NOT NULL"),
    ),
    "drop_duplicate_rows": (
        lambda s, sf: cleaning.drop_duplicate_rows(table(s, sf, "repeated_reviews").select(*FOUR)),
        with_inputs(f"SELECT DISTINCT {FOUR_SQL} FROM repeated_reviews"),
    ),
    "drop_duplicates_by_key": (
        lambda s, sf: ranking.first_per_key(
            _reviews(s, sf).select("review_id", *FOUR), ["app_id"], [F.col("review_id")]
        ),
        with_inputs(
            f"SELECT review_id, {FOUR_SQL} FROM reviews "
            "QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY review_id) = 1"
        ),
    ),
    "null_profile": (
        lambda s, sf: cleaning.null_profile(_reviews(s, sf)),
        with_inputs(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM reviews"
                for c in ["review_id", *FIVE]
            )
        ),
    ),
    "duplicate_count": (
        lambda s, sf: cleaning.duplicate_count(table(s, sf, "repeated_reviews").select(*FOUR)),
        with_inputs(
            "SELECT (SELECT COUNT(*) FROM repeated_reviews) - "
            f"(SELECT COUNT(*) FROM (SELECT DISTINCT {FOUR_SQL} FROM repeated_reviews)) AS duplicates"
        ),
    ),
    "distinct_values": (
        lambda s, sf: cleaning.distinct_values(_reviews(s, sf), "review_score"),
        with_inputs("SELECT DISTINCT review_score FROM reviews"),
    ),
    "table_profile": (
        table_profile,
        with_inputs(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS row_count, "
                f"COUNT({c}) AS non_null FROM reviews"
                for c, t in TYPES.items()
            )
        ),
    ),
    "sample_exact_n": (
        sample_exact_n,
        with_inputs("SELECT * FROM reviews ORDER BY md5('34:' || review_id), review_id LIMIT 500"),
    ),
    "assign_row_id": (assign_row_id, with_inputs(ROW_ID)),
    "filter_class": (
        lambda s, sf: cleaning.filter_class(_reviews(s, sf), -1),
        with_inputs("SELECT * FROM reviews WHERE review_score = -1"),
    ),
    "filter_threshold": (
        filter_threshold,
        with_inputs(
            "SELECT game_id, ROUND(score, 6) AS score, occurrence, "
            "ROUND(normalized_score, 6) AS normalized_score FROM normalized WHERE normalized_score > 2"
        ),
    ),
    "positional_lookup": (
        positional_lookup,
        with_inputs(f"SELECT * FROM ({ROW_ID}) WHERE id IN (SELECT app_id FROM reviews)"),
    ),
    "cast_key": (
        cast_key,
        "SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_partkey END AS game_id FROM part",
    ),
    "prune_null_items": (
        prune_null_items,
        with_inputs(
            "SELECT app_id, COALESCE(string_agg(category, '|' ORDER BY pos), '') AS categories "
            "FROM tag_cells GROUP BY app_id"
        ),
    ),
    "clean_reviews": (
        clean_reviews,
        with_inputs(
            f"SELECT DISTINCT {FOUR_SQL} FROM (SELECT * FROM reviews WHERE app_name IS NOT NULL "
            "AND review_score IS NOT NULL ORDER BY md5('34:' || review_id), review_id LIMIT 300)"
        ),
    ),
    "unpivot_tags": (
        unpivot_tags,
        with_inputs(
            "SELECT CAST(app_id AS VARCHAR) AS game_id, category AS categories FROM wide_cells"
        ),
    ),
    "pivot_tags_wide": (pivot_tags_wide, WIDE_SQL),
    "transpose_tags_nested": (
        transpose_tags_nested,
        with_inputs(
            "SELECT app_id, COUNT(category) AS n, "
            "COALESCE(string_agg(category, '|' ORDER BY pos), '') AS categories "
            "FROM tag_cells GROUP BY app_id"
        ),
    ),
    "collect_tags": (
        lambda s, sf: tag_lists(s, sf).select(
            "game_id", F.array_join("categories", "|").alias("categories")
        ),
        with_inputs(
            "SELECT game_id, string_agg(category, '|' ORDER BY pos) AS categories "
            "FROM game_tags GROUP BY game_id"
        ),
    ),
}
