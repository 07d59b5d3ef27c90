"""Aggregations, distributions, ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import sqltext as Q
from registry.inputs import rounded, table, tag_lists, with_inputs
from tastegraph import constants as K
from tastegraph.functions import text as X
from tastegraph.operators import nested, profiling, ranking, recommender, scoring
from tastegraph.operators.joins import join_tags_playtime

MEASURED = f"""
SELECT review_id, review_score, length(review_text) AS char_num,
       len({Q.tokens('review_text')}) AS word_num,
       len(regexp_extract_all(review_text, {Q.quoted(K.SENTENCE_PATTERN)})) AS sent_num
FROM reviews WHERE review_score IS NOT NULL
"""


def _measured(spark, sf):
    labelled = table(spark, sf, "reviews").filter(F.col("review_score").isNotNull())
    kept = labelled.select("review_id", "review_score", "review_text")
    return profiling.text_measures(kept).drop("review_text")


def _describe_sql(key):
    group = "GROUP BY review_score" if key == "review_score" else ""
    name = "review_score" if key == "review_score" else "'all' AS g"
    return with_inputs(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS measure, {name}, COUNT({m}) AS n, ROUND(AVG({m}), 6) AS mean,
            ROUND(stddev_samp({m}), 6) AS std, CAST(MIN({m}) AS DOUBLE) AS min,
            CAST(MAX({m}) AS DOUBLE) AS max, ROUND(quantile_cont(CAST({m} AS DOUBLE), 0.25), 6) AS p25,
            ROUND(quantile_cont(CAST({m} AS DOUBLE), 0.5), 6) AS p50,
            ROUND(quantile_cont(CAST({m} AS DOUBLE), 0.75), 6) AS p75 FROM measured {group}"""
            for m in profiling.MEASURES
        ),
        measured=MEASURED,
    )


DESCRIBED = ("mean", "std", "p25", "p50", "p75")


def describe_numeric(spark, sf):
    return rounded(profiling.describe_numeric(_measured(spark, sf)), *DESCRIBED)


def describe_numeric_by_class(spark, sf):
    described = profiling.describe_numeric(_measured(spark, sf), group="review_score")
    return rounded(described, *DESCRIBED)


def _histogram_sql(bins):
    sturges = "(hi - lo) / (log2(n) + 1e0)"
    freedman = "2e0 * (p75 - p25) / pow(n, 1e0 / 3e0)"
    width = f"CASE WHEN {freedman} > 0 THEN least({sturges}, {freedman}) ELSE {sturges} END"
    chosen = str(bins) if bins else f"COALESCE(ceil((hi - lo) / NULLIF({width}, 0)), 1)"
    return with_inputs(
        f"""SELECT m.review_score, CAST(least(COALESCE(floor((m.x - b.lo) / NULLIF(b.width, 0)), 0),
                  b.n_bins - 1) AS BIGINT) AS bin, COUNT(*) AS n
        FROM (SELECT review_score, CAST(word_num AS DOUBLE) AS x FROM measured) m
        JOIN (SELECT *, (hi - lo) / n_bins AS width FROM
              (SELECT *, {chosen} AS n_bins FROM
               (SELECT review_score, CAST(COUNT(*) AS DOUBLE) AS n, CAST(MIN(word_num) AS DOUBLE) AS lo,
                       CAST(MAX(word_num) AS DOUBLE) AS hi,
                       quantile_cont(CAST(word_num AS DOUBLE), 0.25) AS p25,
                       quantile_cont(CAST(word_num AS DOUBLE), 0.75) AS p75
                FROM measured GROUP BY review_score))) b
        ON m.review_score = b.review_score GROUP BY 1, 2""",
        measured=MEASURED,
    )


def histogram_by_class(spark, sf):
    return profiling.histogram_by_class(_measured(spark, sf), "word_num")


def histogram_fixed_bins(spark, sf):
    return profiling.histogram_by_class(_measured(spark, sf), "word_num", bins=20)


def term_frequency_by_class(spark, sf):
    labelled = table(spark, sf, "reviews").filter(F.col("review_score").isNotNull())
    converted = X.convert_text(F.col("review_text"), stem=False)
    rows = labelled.select("review_score", converted.alias("converted_text"))
    return rounded(profiling.term_frequency_by_class(rows), "weight")


TERM_SQL = with_inputs(
    f"""SELECT review_score, term, n, ROUND(n / MAX(n) OVER (PARTITION BY review_score), 6) AS weight
    FROM (SELECT review_score, term, COUNT(*) AS n FROM
          (SELECT review_score, unnest(string_split({Q.converted('review_text')}, ' ')) AS term
           FROM reviews WHERE review_score IS NOT NULL) WHERE term <> '' GROUP BY review_score, term)
    QUALIFY row_number() OVER (PARTITION BY review_score ORDER BY n DESC, term) <= 200"""
)


def game_score(spark, sf):
    weighed = scoring.weigh_reviews(table(spark, sf, "scored_reviews"))
    return rounded(scoring.game_score(weighed), "score")


def user_category_score(spark, sf):
    joined = join_tags_playtime(tag_lists(spark, sf), table(spark, sf, "playtimes"))
    exploded = nested.explode_tags_outer(recommender.near_users(joined)).withColumnRenamed("categories", "category")
    return recommender.user_category_score(exploded)


def _played(spark, sf):
    played = table(spark, sf, "playtimes")
    return played.withColumnRenamed("playtime_forever", "predicted_score")


def top_k_per_user(spark, sf):
    order = [F.desc("predicted_score"), F.col("game_id")]
    return ranking.top_k_per_group(_played(spark, sf), ["user_id"], order, K.TOP_N)


def rank_reset(spark, sf):
    order = [F.desc("predicted_score"), F.col("game_id")]
    kept = top_k_per_user(spark, sf).filter(F.col("predicted_score") < 100).drop("rank")
    return ranking.rank_reset(kept, ["user_id"], order)


PLAYED = "SELECT user_id, game_id, playtime_forever AS predicted_score FROM playtimes"
RANK = "row_number() OVER (PARTITION BY user_id ORDER BY predicted_score DESC, game_id)"
TOP = f"SELECT *, {RANK} AS rank FROM ({PLAYED}) QUALIFY {RANK} <= 10"
PAIRS = [("char_num", "word_num"), ("char_num", "sent_num"), ("word_num", "sent_num")]

QUERIES = {
    "game_score": (
        game_score,
        with_inputs("SELECT game_id, ROUND(score, 6) AS score FROM scores"),
    ),
    "value_counts": (
        lambda s, sf: profiling.value_counts(table(s, sf, "reviews"), "app_name"),
        with_inputs(
            "SELECT app_name, COUNT(*) AS n FROM reviews WHERE app_name IS NOT NULL GROUP BY app_name"
        ),
    ),
    "user_category_score": (user_category_score, with_inputs("SELECT * FROM profile")),
    "max_playtime": (
        lambda s, sf: profiling.max_playtime(table(s, sf, "playtimes")),
        with_inputs("SELECT MAX(playtime_forever) AS max_playtime FROM playtimes"),
    ),
    "describe_numeric": (describe_numeric, _describe_sql("all")),
    "describe_numeric_by_class": (describe_numeric_by_class, _describe_sql("review_score")),
    "describe_object": (
        lambda s, sf: profiling.describe_object(table(s, sf, "repeated_reviews"), "review_text"),
        with_inputs(
            """SELECT CAST(SUM(n) AS BIGINT) AS n, COUNT(*) AS n_unique,
            (SELECT review_text FROM (SELECT review_text, COUNT(*) AS n FROM repeated_reviews GROUP BY 1)
             ORDER BY n DESC, review_text LIMIT 1) AS top, MAX(n) AS freq
            FROM (SELECT review_text, COUNT(*) AS n FROM repeated_reviews GROUP BY 1)"""
        ),
    ),
    "class_share": (
        lambda s, sf: profiling.class_share(table(s, sf, "reviews")),
        with_inputs(
            "SELECT review_score, COUNT(*) AS n, ROUND(1e2 * COUNT(*) / SUM(COUNT(*)) OVER (), 2) AS percent "
            "FROM reviews WHERE review_score IS NOT NULL GROUP BY review_score"
        ),
    ),
    "histogram_by_class": (histogram_by_class, _histogram_sql(None)),
    "histogram_fixed_bins": (histogram_fixed_bins, _histogram_sql(20)),
    "term_frequency_by_class": (term_frequency_by_class, TERM_SQL),
    "correlation_matrix": (
        lambda s, sf: rounded(
            profiling.correlation_matrix(_measured(s, sf), list(profiling.MEASURES)), "r"
        ),
        with_inputs(
            " UNION ALL ".join(
                f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 6) AS r FROM measured"
                for a, b in PAIRS
            ),
            measured=MEASURED,
        ),
    ),
    "rank_items": (
        lambda s, sf: ranking.rank_items(_played(s, sf)),
        with_inputs(f"SELECT *, {RANK} AS rank FROM ({PLAYED})"),
    ),
    "top_k_per_user": (top_k_per_user, with_inputs(f"SELECT * REPLACE (CAST(rank AS INTEGER) AS rank) FROM ({TOP})")),
    "rank_reset": (
        rank_reset,
        with_inputs(
            f"SELECT user_id, game_id, predicted_score, CAST({RANK} - 1 AS INTEGER) AS position "
            f"FROM ({TOP}) WHERE predicted_score < 100"
        ),
    ),
}
