"""Review, tag and playtime tables derived from the given tables.

The SQL texts below run in Spark and in the SQL check alike, over whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Review n belongs to game floor(sqrt(n)): the games grow with the reviews and the
# newest game has the most. Games of one brand have no name.
REVIEWS = """
SELECT d.doc_id AS review_id, CAST(floor(sqrt(d.doc_id)) AS BIGINT) AS app_id,
       CASE WHEN p.p_brand <> 'Brand#7' THEN p.p_name END AS app_name,
       d.text AS review_text, 2 * l.quality - 1 AS review_score,
       COALESCE(l.toxic, 0) AS review_votes
FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id
LEFT JOIN part p ON p.p_partkey = CAST(floor(sqrt(d.doc_id)) AS BIGINT)
"""

# The same with the reviews that got votes listed twice.
REPEATED_REVIEWS = """
SELECT * FROM reviews UNION ALL SELECT * FROM reviews WHERE review_votes > 0
"""

# Cleaned reviews with a supplied signed confidence between 0.5 and 1.
SCORED_REVIEWS = """
SELECT review_id, app_id, review_score, review_votes,
       review_score * (50 + (review_id * 37) % 50) / 1e2 AS signed_conf
FROM reviews WHERE review_score IS NOT NULL AND app_name IS NOT NULL
"""

# Up to three tags per game by position; a missing tag is null, and games of one
# brand have none at all.
_TAG = "CASE WHEN p_brand <> 'Brand#11' THEN {} END"
TAG_CELLS = " UNION ALL ".join(
    f"SELECT p_partkey AS app_id, {pos} AS pos, {_TAG.format(tag)} AS category FROM part"
    for pos, tag in enumerate(
        ["split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)", "CASE WHEN p_size > 15 THEN p_type END"]
    )
)

# Cells of a wide table: a column per brand, a ragged row per part.
WIDE_CELLS = """
SELECT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS app_id, p_partkey AS pos, p_name AS category
FROM part
"""
BRANDS = list(range(1, 26))

# One row per user and game; user ids need 64 bits.
PLAYTIMES = """
SELECT 10000000000000000 + o.o_custkey AS user_id, l.l_partkey AS game_id,
       SUM(l.l_quantity) AS playtime_forever
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_custkey, l.l_partkey
"""

# The library entries behind them, in the order they arrive.
LIBRARY = """
SELECT 10000000000000000 + o.o_custkey AS user_id, l.l_partkey AS app_id,
       l.l_quantity AS playtime_forever, l.l_discount AS playtime_windows_forever,
       o.o_orderkey * 10 + l.l_linenumber AS place
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

GAME_TAGS = "SELECT app_id AS game_id, pos, category FROM tag_cells WHERE category IS NOT NULL"
OCCURRENCES = "SELECT app_id AS game_id, COUNT(*) AS occurrence FROM reviews GROUP BY app_id"
WEIGHED = """
SELECT review_id, app_id, CAST(review_score AS DOUBLE)
       + (1e0 + 1e-1 * review_score * review_votes) * signed_conf AS weight
FROM scored_reviews
"""
SCORES = "SELECT app_id AS game_id, SUM(weight) AS score FROM weighed GROUP BY app_id"
NORMALIZED = """
SELECT s.game_id, s.score, o.occurrence,
       s.score / o.occurrence * (8e-1 + 2e-1 * o.occurrence / (o.occurrence + 2e1)) / 2e0 * 1e1
         AS normalized_score
FROM scores s LEFT JOIN occurrences o ON s.game_id = o.game_id
"""
# Scored games with tags.
GAMES = "SELECT n.* FROM normalized n WHERE n.game_id IN (SELECT game_id FROM game_tags)"
PROFILE = """
SELECT p.user_id, t.category, SUM(p.playtime_forever) AS user_category_score
FROM playtimes p JOIN game_tags t ON p.game_id = t.game_id GROUP BY p.user_id, t.category
"""
SHARES = """
SELECT user_id, category,
       user_category_score / SUM(user_category_score) OVER (PARTITION BY user_id) AS weight
FROM profile
"""
# Game side of the content score.
TAG_WEIGHTS = """
SELECT t.game_id, t.category, COUNT(*) / (1e0 + MAX(c.n)) AS w
FROM game_tags t
JOIN (SELECT game_id, COUNT(*) AS n FROM game_tags GROUP BY game_id) c ON t.game_id = c.game_id
JOIN games g ON t.game_id = g.game_id
GROUP BY t.game_id, t.category
"""

CTES = {
    "reviews": REVIEWS,
    "repeated_reviews": REPEATED_REVIEWS,
    "scored_reviews": SCORED_REVIEWS,
    "tag_cells": TAG_CELLS,
    "wide_cells": WIDE_CELLS,
    "playtimes": PLAYTIMES,
    "library": LIBRARY,
    "game_tags": GAME_TAGS,
    "occurrences": OCCURRENCES,
    "weighed": WEIGHED,
    "scores": SCORES,
    "normalized": NORMALIZED,
    "games": GAMES,
    "profile": PROFILE,
    "shares": SHARES,
    "tag_weights": TAG_WEIGHTS,
}


def _uses(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)]


def with_inputs(body: str, **extra: str) -> str:
    """Prefix a SELECT with the input tables (and ``extra`` ones) that it reads."""
    known = CTES | extra
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _uses(text, known):
            if name not in order:
                visit(known[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    tables = ", ".join(f"{name} AS ({known[name]})" for name in order)
    return f"WITH {tables} {body}"


def materialized(sql: str) -> str:
    """The same for DuckDB with every table of the WITH list computed once."""
    return re.sub(r"\b(\w+) AS \((?=\s*(?:SELECT|WITH))", r"\1 AS MATERIALIZED (", sql)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; how it is split is up to ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables as a DataFrame."""
    text = with_inputs(f"SELECT * FROM {name}")
    sources = {n: given(spark, sf_dir, n) for n in _uses(text, GIVEN)}
    for n in sources:
        text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **sources)


def tag_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, categories) with tags in position order."""
    from tastegraph.operators.nested import collect_tags

    lists = collect_tags(table(spark, sf_dir, "tag_cells"))
    return lists.withColumnRenamed("app_id", "game_id")


# A user's library comes in up to so many messages, so that no message grows with a
# heavy user alone. Entries of one game stay together.
LIBRARY_PARTS = 16


def library_part(game: str) -> Column:
    return F.pmod(F.xxhash64(F.col(game)), F.lit(LIBRARY_PARTS)).alias("part")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})

