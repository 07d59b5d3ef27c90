"""Offline scoring: reviews to converted text, classifier, game scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions import text as X
from tastegraph.functions.scoring import signed_confidence
from tastegraph.operators.classifiers import (
    TermClassifier,
    fit_naive_bayes,
    load_classifier,
    predict,
    predict_all,
    save_classifier,
)
from tastegraph.operators.cleaning import distinct_reviews
from tastegraph.operators.evaluation import model_comparison
from tastegraph.operators.features import (
    Vocabulary,
    fit_vocabulary,
    train_test_split,
    with_tfidf,
)
from tastegraph.operators.linear import fit_modified_huber
from tastegraph.operators.scoring import game_score, weigh_reviews
from tastegraph.operators.trees import TreeClassifier, fit_tree_classifier

#: The models that are compared: three naive Bayes variants, the linear one, the tree.
ALL_KINDS = ("multinomial_nb", "bernoulli_nb", "gaussian_nb", "sgd", "tree")


def convert_reviews(reviews: DataFrame, stem: bool = True) -> DataFrame:
    """Cleaned reviews with counts and converted text.

    The result is read by several passes; store it with ``materialize_if_absent``.
    """
    text, tokens = F.col("review_text"), F.col("tokens")
    # Tokens are counted and converted from one tokenisation (case does not matter to it).
    tokenized = distinct_reviews(reviews).withColumn("tokens", X.tokenize_words(F.lower(text)))
    return tokenized.withColumns(
        {
            "char_num": X.char_num(text),
            "word_num": F.size(tokens),
            "sent_num": X.sent_num(text),
            "converted_text": X.convert_tokens(tokens, stem),
        }
    ).drop("tokens")


def fit_classifiers(
    train: DataFrame, vocabulary: Vocabulary, kinds: Sequence[str], key: str = "review_id", **sgd
) -> list[TermClassifier | TreeClassifier]:
    """Fit the named classifiers on TF-IDF arrays; ``sgd`` options go to that one.

    The tree reads the converted texts of the same rows.
    """
    size = len(vocabulary.terms)
    bayes = [kind for kind in kinds if kind not in ("sgd", "tree")]
    models = fit_naive_bayes(train, size, bayes) if bayes else []
    if "sgd" in kinds:
        models.append(fit_modified_huber(train, size, key=key, **sgd))
    if "tree" in kinds:
        models.append(fit_tree_classifier(train, vocabulary))
    return models


def fit_scorer(
    converted: DataFrame,
    kind: str = "sgd",
    max_features: int = K.SCORER_VOCABULARY,
    key: str = "review_id",
) -> tuple[Vocabulary, TermClassifier]:
    """Vocabulary over all reviews, classifier on the training part."""
    vocabulary = fit_vocabulary(converted, key, max_features=max_features)
    features = with_tfidf(converted, vocabulary)
    train, _ = train_test_split(features, key)
    return vocabulary, fit_classifiers(train, vocabulary, [kind], key)[0]


def score_reviews(
    converted: DataFrame, vocabulary: Vocabulary, model: TermClassifier
) -> DataFrame:
    """Add prediction, signed confidence and weight to every review."""
    scored = predict(with_tfidf(converted, vocabulary), model)
    confidence = signed_confidence(F.col("p_positive"), F.col("converted_text"))
    return weigh_reviews(scored.withColumn("signed_conf", confidence))


def execute_sentiment_analysis(
    texts: DataFrame, vocabulary: Vocabulary, model: TermClassifier, text: str = "text",
    stem: bool = True,
) -> DataFrame:
    """Signed confidence of raw texts; missing text gives 0."""
    converted = texts.withColumn("converted_text", X.convert_text(F.col(text), stem))
    scored = predict(with_tfidf(converted, vocabulary), model)
    confidence = signed_confidence(F.col("p_positive"), F.col(text))
    kept = scored.withColumn("signed_conf", confidence)
    return kept.drop("idx", "val", "converted_text")


def score_games(converted: DataFrame, vocabulary: Vocabulary, model: TermClassifier) -> DataFrame:
    return game_score(score_reviews(converted, vocabulary, model))


def evaluate_models(
    converted: DataFrame,
    kinds: Sequence[str],
    max_features: int = K.COMPARISON_VOCABULARY,
    fit_on_all: bool = False,
    key: str = "review_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Hold-out predictions (model, label, p_positive, prediction) of several models.

    The vocabulary comes from the training part, or from all rows on request.
    """
    train, test = train_test_split(converted, key)
    base = converted if fit_on_all else train
    vocabulary = fit_vocabulary(base, key, max_features=max_features)
    models = fit_classifiers(with_tfidf(train, vocabulary), vocabulary, kinds, key)
    featured = with_tfidf(test, vocabulary).withColumnRenamed("review_score", "label")
    return predict_all(featured, models, [key, "label", *keep])


def compare_models(converted: DataFrame, kinds: Sequence[str], **options) -> DataFrame:
    return model_comparison(evaluate_models(converted, kinds, **options))


def benchmark_texts(
    texts: DataFrame,
    vocabulary: Vocabulary,
    models: Sequence[TermClassifier | TreeClassifier],
    text: str = "text",
    expected: str = "expected",
    stem: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Predictions (model, label, p_positive, prediction) for raw texts with known labels.

    Texts are converted like reviews and scored by all models in one pass. Rows without a
    label or with another one than -1 and 1 are left out; a missing text is scored as empty.
    """
    known = texts.where(F.col(expected).isin(-1, 1)).withColumn("label", F.col(expected).cast("int"))
    converted = known.withColumn("converted_text", X.convert_text(F.coalesce(F.col(text), F.lit("")), stem))
    return predict_all(with_tfidf(converted, vocabulary), models, [*keep, "label"])


def save_scorer(spark: SparkSession, vocabulary: Vocabulary, model: TermClassifier, path: str) -> None:
    """Vectoriser and classifier in one folder."""
    vocabulary.write(spark, f"{path}/vocabulary")
    save_classifier(spark, model, f"{path}/classifier")


def load_scorer(spark: SparkSession, path: str) -> tuple[Vocabulary, TermClassifier]:
    """What ``save_scorer`` wrote, in any session; raises if the two do not fit each other."""
    vocabulary, model = Vocabulary.read(spark, f"{path}/vocabulary"), load_classifier(spark, f"{path}/classifier")
    if len(vocabulary.terms) != len(model.linear):
        raise ValueError(f"{len(model.linear)} weights for {len(vocabulary.terms)} terms below {path}")
    return vocabulary, model
