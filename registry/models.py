"""Features, classifiers, evaluation, scores."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from registry import sqltext as Q
from registry.inputs import materialized, rounded, table, tag_lists, with_inputs
from tastegraph import constants as K
from tastegraph.functions import scoring as S
from tastegraph.operators import (
    classifiers,
    cleaning,
    evaluation,
    features,
    scoring,
)
from tastegraph.plans import scoring as plan
from tastegraph.session import fresh_path, stage

BAYES = ("multinomial_nb", "bernoulli_nb", "gaussian_nb")
KINDS = dict(zip(BAYES, ("multinomial", "bernoulli", "gaussian")))


def _converted(spark, sf, stem=False, keep=()):
    """What the models read of cleaned and converted reviews, stored once for all passes of a query."""
    converted = plan.convert_reviews(table(spark, sf, "reviews"), stem)
    columns = ["review_id", "app_id", "review_score", "review_votes", *keep, "converted_text"]
    return stage(converted.select(columns), "converted")


def tfidf_features(spark, sf):
    converted = _converted(spark, sf)
    vocabulary = features.fit_vocabulary(converted, "review_id", max_features=K.SCORER_VOCABULARY)
    return rounded(features.tfidf_long(converted, "review_id", vocabulary), "weight")


def tfidf_features_large(spark, sf):
    converted = _converted(spark, sf)
    vocabulary = features.fit_vocabulary(converted, "review_id", max_features=K.COMPARISON_VOCABULARY)
    return rounded(features.tfidf_long(converted, "review_id", vocabulary), "weight")


def count_features(spark, sf):
    return features.count_features(_converted(spark, sf), "review_id")


def train_test_split(spark, sf):
    rows = cleaning.distinct_reviews(table(spark, sf, "reviews"))
    return rows.select("review_id", features.in_test_part(F.col("review_id")).alias("in_test"))


def _evaluated(spark, sf, kinds):
    return plan.evaluate_models(_converted(spark, sf), kinds)


def _bayes(kind):
    def run(spark, sf):
        predicted = _evaluated(spark, sf, [kind]).select("review_id", "label", "p_positive", "prediction")
        # Gaussian log odds run to billions, so only the class is compared.
        return predicted.drop("p_positive") if kind == "gaussian_nb" else rounded(predicted, "p_positive")

    return run


CHAIN = Q.chain(K.COMPARISON_VOCABULARY, train_only=True)
SCORER_CHAIN = Q.chain(K.SCORER_VOCABULARY, train_only=False, everything=True)
CLASS = "CASE WHEN p_positive > 5e-1 THEN 1 ELSE -1 END"


def _bayes_sql(kind):
    p = "" if kind == "gaussian_nb" else "ROUND(p_positive, 6) AS p_positive, "
    return with_inputs(
        f"SELECT review_id, label, {p}{CLASS} AS prediction FROM {KINDS[kind]}_p", **CHAIN
    )


def sgd_modified_huber(spark, sf):
    predicted = _evaluated(spark, sf, ["sgd"])
    return predicted.select("review_id", "label", "p_positive", "prediction")


def decision_tree(spark, sf):
    return _evaluated(spark, sf, ["tree"]).select("review_id", "label", "p_positive", "prediction")


def model_comparison_all(spark, sf):
    """Metrics of all five models."""
    return evaluation.model_comparison(_evaluated(spark, sf, plan.ALL_KINDS))


def sort_models_all(spark, sf):
    return _ranked(evaluation.classification_metrics(_evaluated(spark, sf, plan.ALL_KINDS), by="model"))


def compared_rows(spark, sf):
    """Which model is compared on how many rows of each class; the metrics are not SQL's."""
    predicted = _evaluated(spark, sf, plan.ALL_KINDS)
    valid = (F.col("p_positive") >= 0) & (F.col("p_positive") <= 1) & F.col("prediction").isin(-1, 1)
    return predicted.groupBy("model", "label").agg(F.count("*").alias("n"), F.sum(valid.cast("long")).alias("valid"))


def labelled_benchmark_all(spark, sf):
    return evaluation.labelled_benchmark(_evaluated(spark, sf, plan.ALL_KINDS))


def _benchmark(spark, sf):
    """Raw texts with labels, run through a scorer that was saved and loaded again."""
    converted = _converted(spark, sf, keep=["review_text"])
    vocabulary, model = plan.fit_scorer(converted, "multinomial_nb")
    path = fresh_path(spark, "scorer")
    plan.save_scorer(spark, vocabulary, model, path)
    texts = converted.select("review_id", F.col("review_text").alias("text"), F.col("review_score").alias("expected"))
    vocabulary, model = plan.load_scorer(spark.newSession(), path)
    return plan.benchmark_texts(texts, vocabulary, [model], stem=False, keep=["review_id", "text"])


def benchmark_texts(spark, sf):
    return evaluation.labelled_benchmark(_benchmark(spark, sf))


def benchmark_text_misses(spark, sf):
    return evaluation.benchmark_misses(_benchmark(spark, sf)).select("model", "review_id", "label", "text")


def predict_label(spark, sf):
    return _evaluated(spark, sf, BAYES).select("review_id", "model", "label", "prediction")


LONG = " UNION ALL ".join(
    f"SELECT review_id, '{k}' AS model, label, p_positive, {CLASS} AS prediction FROM {KINDS[k]}_p"
    for k in BAYES
)
PREDICTED = CHAIN | {"predicted": LONG}


def signed_confidence(spark, sf):
    scored = _scored_by_bayes(spark, sf)
    return rounded(scored.select("review_id", "signed_conf"), "signed_conf")


def _scored_by_bayes(spark, sf):
    """The offline job with a classifier that SQL can repeat."""
    converted = _converted(spark, sf)
    vocabulary, model = plan.fit_scorer(converted, "multinomial_nb")
    return plan.score_reviews(converted, vocabulary, model)


def score_games(spark, sf):
    return rounded(scoring.game_score(_scored_by_bayes(spark, sf)), "score")


def normalized_ranking(spark, sf):
    """Reviews to classified, weighed, summed, normalised and ranked games."""
    scores = scoring.game_score(_scored_by_bayes(spark, sf))
    normalized = scoring.normalize_scores(scores, table(spark, sf, "reviews"))
    return rounded(normalized, "score", "normalized_score").orderBy(
        F.desc("normalized_score"), "game_id"
    )


CONFIDENT = """
SELECT p.review_id, c.app_id, c.review_score, c.review_votes,
       CASE WHEN c.converted_text = '' THEN 0e0
            WHEN p.p_positive > 5e-1 THEN p.p_positive ELSE p.p_positive - 1e0 END AS signed_conf
FROM multinomial_p p JOIN converted c ON p.review_id = c.review_id
"""
# The supplied confidences are replaced by the classifier's.
CLASSIFIED = SCORER_CHAIN | {"scored_reviews": CONFIDENT}


def sgd_game_scores(spark, sf):
    """The offline job as it is usually run: stemmed text and the linear classifier."""
    converted = _converted(spark, sf, stem=True)
    vocabulary, model = plan.fit_scorer(converted, "sgd")
    return plan.score_games(converted, vocabulary, model)


def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(_evaluated(spark, sf, ["multinomial_nb"]))


def classification_metrics(spark, sf):
    return evaluation.classification_metrics(_evaluated(spark, sf, ["multinomial_nb"]))


def model_comparison(spark, sf):
    return evaluation.model_comparison(_evaluated(spark, sf, BAYES))


def _ranked(metrics):
    """Position of every model by F1; the window sees one row per model."""
    by_f1 = Window.partitionBy().orderBy(F.desc("f1"), "model")
    position = (F.row_number().over(by_f1) - 1).cast("long").alias("position")
    return evaluation.sort_models(metrics).select("model", position)


def sort_models(spark, sf):
    return _ranked(evaluation.classification_metrics(_evaluated(spark, sf, BAYES), by="model"))


def labelled_benchmark(spark, sf):
    return evaluation.labelled_benchmark(_evaluated(spark, sf, BAYES))


def benchmark_misses(spark, sf):
    predicted = plan.evaluate_models(_converted(spark, sf, keep=["review_text"]), BAYES, keep=["review_text"])
    misses = evaluation.benchmark_misses(predicted)
    return misses.select("model", "review_id", "review_text")


def model_persistence(spark, sf):
    """Fit, save, load, predict."""
    converted = _converted(spark, sf)
    train, test = features.train_test_split(converted)
    vocabulary = features.fit_vocabulary(train, "review_id", max_features=K.COMPARISON_VOCABULARY)
    size = len(vocabulary.terms)
    fitted = classifiers.fit_naive_bayes(features.with_tfidf(train, vocabulary), size)[0]
    path = fresh_path(spark, "classifier")
    classifiers.save_classifier(spark, fitted, path)
    loaded = classifiers.load_classifier(spark, path)
    predicted = classifiers.predict(features.with_tfidf(test, vocabulary), loaded)
    return rounded(predicted, "p_positive").select(
        "review_id", F.col("review_score").alias("label"), "p_positive", "prediction"
    )


def review_weight(spark, sf):
    weighed = scoring.weigh_reviews(table(spark, sf, "scored_reviews"))
    return rounded(weighed.select("review_id", "weight"), "weight")


def normalized_score(spark, sf):
    scores = scoring.game_score(scoring.weigh_reviews(table(spark, sf, "scored_reviews")))
    normalized = scoring.normalize_scores(scores, table(spark, sf, "reviews"))
    return rounded(normalized, "score", "normalized_score")


def game_features(spark, sf):
    scores = scoring.game_score(scoring.weigh_reviews(table(spark, sf, "scored_reviews")))
    games = scoring.game_features(scores, table(spark, sf, "reviews"), tag_lists(spark, sf))
    joined = games.withColumn("categories", F.array_join("categories", "|"))
    return rounded(joined, "score", "normalized_score")


CELLS = {
    f"{a}{b}": f"SUM(CASE WHEN label = {a} AND prediction = {b} THEN 1 ELSE 0 END)"
    for a in (1, -1)
    for b in (1, -1)
}
COUNTS = (
    f"SELECT model, 1e0 * {CELLS['11']} AS tp, 1e0 * {CELLS['-11']} AS fp, "
    f"1e0 * {CELLS['1-1']} AS fn, 1e0 * {CELLS['-1-1']} AS tn FROM predicted GROUP BY model"
)


def _ratio(a, b, name):
    return f"ROUND(COALESCE(({a}) / NULLIF({b}, 0), 0e0) * 1e2, 2) AS {name}"


METRICS = ", ".join(
    [
        _ratio("2 * tp", "2 * tp + fp + fn", "f1"),
        _ratio("tp", "tp + fp", "precision"),
        _ratio("tp", "tp + fn", "recall"),
        _ratio("tp + tn", "tp + fp + fn + tn", "accuracy"),
    ]
)

QUERIES = {
    "tfidf_features": (
        tfidf_features,
        with_inputs("SELECT review_id, term, ROUND(x, 6) AS weight FROM tfidf", **SCORER_CHAIN),
    ),
    "tfidf_features_large": (
        tfidf_features_large,
        with_inputs(
            "SELECT review_id, term, ROUND(x, 6) AS weight FROM tfidf",
            **Q.chain(K.COMPARISON_VOCABULARY, train_only=False),
        ),
    ),
    "count_features": (
        count_features,
        materialized(
            with_inputs(
                "SELECT t.review_id, t.term, t.n FROM term_counts t JOIN vocab v ON t.term = v.term",
                **Q.chain(K.COUNT_VOCABULARY, train_only=False),
            )
        ),
    ),
    "train_test_split": (
        train_test_split,
        with_inputs("SELECT review_id, in_test FROM parts", **CHAIN),
    ),
    "sgd_modified_huber": (sgd_modified_huber, None),
    **{f"nb_{KINDS[kind]}": (_bayes(kind), _bayes_sql(kind)) for kind in BAYES},
    "decision_tree": (decision_tree, None),
    "model_comparison_all": (model_comparison_all, None),
    "sort_models_all": (sort_models_all, None),
    "labelled_benchmark_all": (labelled_benchmark_all, None),
    "compared_rows": (
        compared_rows,
        with_inputs(
            "SELECT m.model, p.review_score AS label, COUNT(*) AS n, COUNT(*) AS valid FROM parts p "
            "CROSS JOIN (SELECT unnest(['multinomial_nb', 'bernoulli_nb', 'gaussian_nb', 'sgd', 'tree']) AS model) m "
            "WHERE p.in_test GROUP BY m.model, p.review_score",
            **CHAIN,
        ),
    ),
    "benchmark_texts": (
        benchmark_texts,
        with_inputs(
            "SELECT 'multinomial_nb' AS model, CAST(SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS hits, "
            f"COUNT(*) AS n FROM (SELECT label, {CLASS} AS prediction FROM multinomial_p)",
            **SCORER_CHAIN,
        ),
    ),
    "benchmark_text_misses": (
        benchmark_text_misses,
        with_inputs(
            "SELECT 'multinomial_nb' AS model, p.review_id, p.label, r.review_text AS text "
            f"FROM (SELECT review_id, label, {CLASS} AS prediction FROM multinomial_p) p "
            "JOIN reviews r ON p.review_id = r.review_id WHERE p.label <> p.prediction",
            **SCORER_CHAIN,
        ),
    ),
    "predict_label": (
        predict_label,
        with_inputs("SELECT review_id, model, label, prediction FROM predicted", **PREDICTED),
    ),
    "signed_confidence": (
        signed_confidence,
        with_inputs(
            "SELECT review_id, ROUND(signed_conf, 6) AS signed_conf FROM scored_reviews", **CLASSIFIED
        ),
    ),
    "score_games": (
        score_games,
        with_inputs("SELECT game_id, ROUND(score, 6) AS score FROM scores", **CLASSIFIED),
    ),
    "normalized_ranking": (
        normalized_ranking,
        with_inputs(
            "SELECT game_id, ROUND(score, 6) AS score, occurrence, "
            "ROUND(normalized_score, 6) AS normalized_score FROM normalized",
            **CLASSIFIED,
        ),
    ),
    "sgd_game_scores": (sgd_game_scores, None),
    "confusion_matrix": (
        confusion_matrix,
        with_inputs(
            f"""SELECT a.v AS label, b.v AS prediction, COUNT(p.review_id) AS n
            FROM (VALUES (-1), (1)) a(v) CROSS JOIN (VALUES (-1), (1)) b(v)
            LEFT JOIN (SELECT review_id, label, {CLASS} AS prediction FROM multinomial_p) p
            ON p.label = a.v AND p.prediction = b.v GROUP BY a.v, b.v""",
            **CHAIN,
        ),
    ),
    "classification_metrics": (
        classification_metrics,
        with_inputs(
            f"SELECT {METRICS} FROM ({COUNTS}) WHERE model = 'multinomial_nb'", **PREDICTED
        ),
    ),
    "model_comparison": (
        model_comparison,
        with_inputs(f"SELECT model, {METRICS} FROM ({COUNTS})", **PREDICTED),
    ),
    "sort_models": (
        sort_models,
        with_inputs(
            "SELECT model, row_number() OVER (ORDER BY f1 DESC, model) - 1 AS position "
            f"FROM (SELECT model, {METRICS} FROM ({COUNTS}))",
            **PREDICTED,
        ),
    ),
    "labelled_benchmark": (
        labelled_benchmark,
        with_inputs(
            "SELECT model, CAST(SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS hits, "
            "COUNT(*) AS n FROM predicted GROUP BY model",
            **PREDICTED,
        ),
    ),
    "benchmark_misses": (
        benchmark_misses,
        with_inputs(
            "SELECT p.model, p.review_id, r.review_text FROM predicted p JOIN reviews r "
            "ON p.review_id = r.review_id WHERE p.label <> p.prediction",
            **PREDICTED,
        ),
    ),
    "model_persistence": (model_persistence, _bayes_sql("multinomial_nb")),
    "review_weight": (
        review_weight,
        with_inputs("SELECT review_id, ROUND(weight, 6) AS weight FROM weighed"),
    ),
    "normalized_score": (
        normalized_score,
        with_inputs(
            "SELECT game_id, ROUND(score, 6) AS score, occurrence, "
            "ROUND(normalized_score, 6) AS normalized_score FROM normalized"
        ),
    ),
    "game_features": (
        game_features,
        with_inputs(
            """SELECT g.game_id, ROUND(g.normalized_score, 6) AS normalized_score, t.categories,
            g.occurrence, ROUND(g.score, 6) AS score FROM games g
            JOIN (SELECT game_id, string_agg(category, '|' ORDER BY pos) AS categories
                  FROM game_tags GROUP BY game_id) t ON g.game_id = t.game_id"""
        ),
    ),
}
