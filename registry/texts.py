"""Text functions, run over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import sqltext as Q
from registry.inputs import given, table, with_inputs
from tastegraph import constants as K
from tastegraph.functions import scoring
from tastegraph.functions import text as X
from tastegraph.operators import sentences


def _each(expression, name):
    def run(spark, sf):
        value = expression(F.col("review_text")).alias(name)
        return table(spark, sf, "reviews").select("review_id", value)

    return run


def _md5_tokens(tokens):
    return F.md5(F.array_join(tokens, " "))


def _sql(expression, name):
    return with_inputs(f"SELECT review_id, {expression} AS {name} FROM reviews")


def extract_links(spark, sf):
    links = X.extract_links(F.col("html"), r'href="(/([^"/?#]+))"')
    return given(spark, sf, "pages").select("page_id", F.explode(links).alias("link"))


def url_unquote(spark, sf):
    """Addresses with escaped slashes, a plus sign and a stray percent sign."""
    escaped = F.concat(F.replace("url", F.lit("/"), F.lit("%2F")), F.lit("+%C3%A9%"))
    return given(spark, sf, "pages").select("page_id", X.url_unquote(escaped).alias("url"))


def missing_text_guard(spark, sf):
    """Converted texts of junk reviews may be empty and then score 0."""
    converted = X.convert_text(F.col("review_text"), stem=False)
    value = X.missing_text_guard(F.col("converted_text"), F.lit(0.75))
    rows = table(spark, sf, "reviews").withColumn("converted_text", converted)
    return rows.select("review_id", value.alias("value"))


def round_percent(spark, sf):
    share = F.length(F.regexp_replace("review_text", "[^e]", "")) / F.length("review_text")
    return table(spark, sf, "reviews").select("review_id", scoring.percent(share).alias("percent"))


def sentence_abbreviations(spark, sf):
    scores = sentences.abbreviation_scores(table(spark, sf, "reviews"), "review_text")
    return scores.where(F.col("score") >= sentences.LEAST_SCORE).select("type", "n", "with_period")


def sent_num_trained(spark, sf):
    """Sentences per review, with abbreviations learned from all reviews."""
    reviews = table(spark, sf, "reviews")
    known = sentences.fit_abbreviations(reviews, "review_text")
    return reviews.select("review_id", sentences.sentence_count(F.col("review_text"), known).alias("sent_num"))


def _bare(word):
    opened = f"regexp_replace({word}, {Q.quoted(sentences.OPENING)}, '')"
    return f"regexp_replace({opened}, {Q.quoted(sentences.CLOSING)}, '')"


_WORDS = f"regexp_extract_all(review_text, {Q.quoted(sentences.WORDS)})"
TYPES = {
    "tokens": f"SELECT lower({_bare('w')}) AS w FROM (SELECT unnest({_WORDS}) AS w FROM reviews)",
    "types": f"""
SELECT CASE WHEN w LIKE '%.' THEN substr(w, 1, length(w) - 1)
            ELSE regexp_replace(w, {Q.quoted(sentences.OTHER_ENDS)}, '') END AS type,
       COUNT(*) AS n, CAST(SUM(CASE WHEN w LIKE '%.' THEN 1 ELSE 0 END) AS BIGINT) AS with_period
FROM tokens GROUP BY 1
""",
    "periods": f"SELECT least(SUM(with_period) / (1e0 * SUM(n)), {sentences.OWN_PERIODS}) AS share FROM types",
    "abbreviations": rf"""
SELECT type, n, with_period FROM types CROSS JOIN periods
WHERE with_period > 0 AND regexp_matches(type, '\p{{L}}') AND NOT regexp_matches(type, '\p{{N}}')
  AND 2 * (with_period * ln({sentences.OWN_PERIODS}) + (n - with_period) * ln(1 - {sentences.OWN_PERIODS})
           - with_period * ln(share) - (n - with_period) * ln(1 - share))
      * exp(-1e0 * length(replace(type, '.', ''))) * (length(type) - length(replace(type, '.', '')) + 1)
      * pow(length(replace(type, '.', '')), -1e0 * (n - with_period)) >= {sentences.LEAST_SCORE}
""",
    "word_pairs": f"SELECT review_id, unnest(list_zip(w[1:len(w) - 1], w[2:])) AS p, len(w) AS n FROM (SELECT review_id, {_WORDS} AS w FROM reviews)",
    "bare_pairs": f"""
SELECT review_id, {_bare('p[1]')} AS word, regexp_replace(p[2], {Q.quoted(sentences.OPENING)}, '') AS after
FROM word_pairs
""",
    "breaks": r"""
SELECT review_id, COUNT(*) AS n FROM
  (SELECT *, lower(substr(word, 1, length(word) - 1)) AS stem FROM bare_pairs WHERE regexp_matches(word, '[.!?]$'))
WHERE regexp_matches(word, '[!?]$')
   OR (NOT regexp_matches(after, '^\p{Ll}') AND NOT regexp_matches(stem, '^\p{L}$')
       AND stem NOT IN (SELECT type FROM abbreviations)
       AND (NOT regexp_matches(stem, '^[\p{N}.,]+$')
            OR (regexp_matches(after, '^\p{Lu}') AND NOT regexp_matches(after, '^\p{Lu}\.'))))
GROUP BY review_id
""",
}

QUERIES = {
    "sentence_abbreviations": (
        sentence_abbreviations,
        with_inputs("SELECT * FROM abbreviations", **TYPES),
    ),
    "sent_num_trained": (
        sent_num_trained,
        with_inputs(
            f"SELECT r.review_id, CAST(CASE WHEN len({_WORDS}) = 0 THEN 0 ELSE COALESCE(b.n, 0) + 1 END AS INTEGER) AS sent_num "
            "FROM reviews r LEFT JOIN breaks b ON r.review_id = b.review_id",
            **TYPES,
        ),
    ),
    "text_lower": (_each(lambda t: F.md5(X.lower(t)), "text_md5"), _sql("md5(lower(review_text))", "text_md5")),
    "tokenize_words": (
        _each(lambda t: _md5_tokens(X.tokenize_words(t)), "tokens_md5"),
        _sql(Q.joined(Q.tokens("review_text")), "tokens_md5"),
    ),
    "remove_stopwords": (
        _each(lambda t: _md5_tokens(X.remove_stop_words(X.tokenize_words(F.lower(t)))), "tokens_md5"),
        _sql(Q.joined(Q.without_stop_words(Q.tokens("lower(review_text)"))), "tokens_md5"),
    ),
    "remove_punctuation": (
        _each(lambda t: _md5_tokens(X.remove_punctuation(X.tokenize_words(t))), "tokens_md5"),
        _sql(Q.joined(Q.without_punctuation(Q.tokens("review_text"))), "tokens_md5"),
    ),
    "join_tokens": (
        _each(lambda t: F.md5(X.join_tokens(X.tokenize_words(t))), "text_md5"),
        _sql(Q.joined(Q.tokens("review_text")), "text_md5"),
    ),
    "stem_tokens": (
        _each(lambda t: F.md5(X.stem_text(X.join_tokens(X.tokenize_words(t)))), "text_md5"),
        None,
    ),
    "convert_text": (_each(lambda t: X.convert_text(t), "converted_text"), None),
    "convert_text_unstemmed": (
        _each(lambda t: X.convert_text(t, stem=False), "converted_text"),
        _sql(Q.converted("review_text"), "converted_text"),
    ),
    "char_num": (_each(lambda t: X.char_num(t), "char_num"), _sql("CAST(length(review_text) AS INTEGER)", "char_num")),
    "word_num": (
        _each(lambda t: X.word_num(t), "word_num"),
        _sql(f"CAST(len({Q.tokens('review_text')}) AS INTEGER)", "word_num"),
    ),
    "sent_num": (
        _each(lambda t: X.sent_num(t), "sent_num"),
        _sql(
            f"CAST(len(regexp_extract_all(review_text, {Q.quoted(K.SENTENCE_PATTERN)})) AS INTEGER)",
            "sent_num",
        ),
    ),
    "extract_links": (
        extract_links,
        """SELECT page_id, unnest(regexp_extract_all(html, 'href="(/([^"/?#]+))"', 2)) AS link FROM pages""",
    ),
    "url_unquote": (url_unquote, "SELECT page_id, url || '+é%' AS url FROM pages"),
    "missing_text_guard": (
        missing_text_guard,
        _sql(f"CASE WHEN {Q.converted('review_text')} = '' THEN 0e0 ELSE 75e-2 END", "value"),
    ),
    "round_percent": (
        round_percent,
        _sql(
            "ROUND(100e0 * length(regexp_replace(review_text, '[^e]', '', 'g')) / length(review_text), 2)",
            "percent",
        ),
    ),
}
