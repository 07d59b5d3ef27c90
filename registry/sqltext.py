"""SQL forms of the text and classifier steps, for the checks only."""

from __future__ import annotations

from tastegraph import constants as K


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens(text: str) -> str:
    spaced = f"regexp_replace({text}, {quoted(K.CLITIC_PATTERN)}, '\\1 \\2 \\3', 'g')"
    marked = f"regexp_replace({spaced}, {quoted(K.OPEN_QUOTE_PATTERN)}, '\\1 `` ', 'g')"
    marked = f"replace({marked}, '\"', ' '''' ')"
    return f"regexp_extract_all({marked}, {quoted(K.TOKEN_PATTERN)})"


STOP_LIST = "(" + ", ".join(quoted(w) for w in K.STOP_WORDS) + ")"


def without_stop_words(array: str) -> str:
    return f"list_filter({array}, lambda t: t NOT IN {STOP_LIST})"


def without_punctuation(array: str) -> str:
    return f"list_filter({array}, lambda t: instr({quoted(K.PUNCTUATION)}, t) = 0)"


def converted(text: str) -> str:
    kept = without_punctuation(without_stop_words(tokens(f"lower({text})")))
    return f"array_to_string({kept}, ' ')"


def joined(array: str) -> str:
    return f"md5(array_to_string({array}, ' '))"


CLEAN = """
SELECT MIN(review_id) AS review_id, app_id, app_name, review_score, review_text, review_votes
FROM reviews WHERE app_name IS NOT NULL AND review_score IS NOT NULL
GROUP BY app_id, app_name, review_score, review_text, review_votes
"""
CONVERTED = f"SELECT *, {converted('review_text')} AS converted_text FROM clean"
PARTS = (
    "SELECT review_id, review_score, "
    "CAST('0x' || substr(md5('34:' || review_id), 1, 8) AS BIGINT) % 10 < 2 AS in_test FROM converted"
)
TERM_COUNTS = f"""
SELECT review_id, term, COUNT(*) AS n FROM
  (SELECT review_id, unnest(regexp_extract_all(lower(converted_text), {quoted(K.TERM_PATTERN)})) AS term
   FROM converted) GROUP BY review_id, term
"""


def vocabulary(size: int, train_only: bool) -> str:
    part = "WHERE NOT in_test" if train_only else ""
    return f"""
SELECT t.term, SUM(t.n) AS n, COUNT(*) AS df,
       ln((1e0 + (SELECT COUNT(*) FROM parts {part})) / (1e0 + COUNT(*))) + 1e0 AS idf
FROM term_counts t JOIN (SELECT review_id FROM parts {part}) p ON t.review_id = p.review_id
GROUP BY t.term ORDER BY n DESC, t.term LIMIT {size}
"""


TFIDF = """
SELECT t.review_id, t.term,
       t.n * v.idf / sqrt(SUM((t.n * v.idf) * (t.n * v.idf)) OVER (PARTITION BY t.review_id)) AS x
FROM term_counts t JOIN vocab v ON t.term = v.term
"""
# Class sums over the training part, for every (class, term) of the vocabulary.
CLASS_SIZES = "SELECT review_score, COUNT(*) AS docs FROM parts WHERE NOT in_test GROUP BY review_score"
CLASS_SUMS = """
SELECT c.review_score, c.docs, v.term, COALESCE(SUM(f.x), 0e0) AS s,
       COALESCE(SUM(f.x * f.x), 0e0) AS q, COUNT(f.x) AS n
FROM class_sizes c CROSS JOIN (SELECT term FROM vocab) v
LEFT JOIN (SELECT p.review_score, t.term, t.x FROM tfidf t JOIN parts p
           ON t.review_id = p.review_id WHERE NOT p.in_test) f
  ON f.review_score = c.review_score AND f.term = v.term
GROUP BY c.review_score, c.docs, v.term
"""
PRIOR = "SELECT SUM(review_score * ln(docs)) AS prior FROM class_sizes"
MULTINOMIAL = """
SELECT term, SUM(review_score * ln((s + 1e0) / total)) AS w, 0e0 AS b, 0e0 AS q FROM
  (SELECT *, SUM(s + 1e0) OVER (PARTITION BY review_score) AS total FROM class_sums) GROUP BY term
"""
BERNOULLI = """
SELECT term, SUM(review_score * ln(p / (1e0 - p))) AS w, SUM(review_score * ln(1e0 - p)) AS b,
       0e0 AS q
FROM (SELECT *, (n + 1e0) / (docs + 2e0) AS p FROM class_sums) GROUP BY term
"""
SMOOTHING = """
SELECT 1e-9 * MAX(v) AS eps FROM
  (SELECT SUM(q) / SUM(docs) - (SUM(s) / SUM(docs)) * (SUM(s) / SUM(docs)) AS v
   FROM class_sums GROUP BY term)
"""
GAUSSIAN = """
SELECT term, SUM(review_score * m / v) AS w,
       SUM(review_score * (-5e-1 * ln(2e0 * pi() * v) - m * m / (2e0 * v))) AS b,
       SUM(review_score * -5e-1 / v) AS q
FROM (SELECT *, s / docs AS m,
             greatest(q / docs - (s / docs) * (s / docs), 0e0) + (SELECT eps FROM smoothing) AS v
      FROM class_sums) GROUP BY term
"""


def predictions(weights: str, part: str, x: str = "x") -> str:
    """Probability and class of every review of a part; no known term leaves the prior."""
    return f"""
SELECT p.review_id, p.review_score AS label,
       1e0 / (1e0 + exp(-((SELECT prior FROM prior) + (SELECT SUM(b) FROM {weights})
              + COALESCE(SUM({x} * w.w + x * x * w.q), 0e0)))) AS p_positive
FROM parts p LEFT JOIN tfidf t ON p.review_id = t.review_id LEFT JOIN {weights} w ON t.term = w.term
{part} GROUP BY p.review_id, p.review_score
"""


def chain(size: int, train_only: bool, everything: bool = False) -> dict[str, str]:
    """All tables from reviews to predictions, as CTEs for ``with_inputs``."""
    part = "" if everything else "WHERE p.in_test"
    return {
        "clean": CLEAN,
        "converted": CONVERTED,
        "parts": PARTS,
        "term_counts": TERM_COUNTS,
        "vocab": vocabulary(size, train_only),
        "tfidf": TFIDF,
        "class_sizes": CLASS_SIZES,
        "class_sums": CLASS_SUMS,
        "prior": PRIOR,
        "multinomial": MULTINOMIAL,
        "bernoulli": BERNOULLI,
        "smoothing": SMOOTHING,
        "gaussian": GAUSSIAN,
        "multinomial_p": predictions("multinomial", part),
        "bernoulli_p": predictions("bernoulli", part, "1e0"),
        "gaussian_p": predictions("gaussian", part),
    }
