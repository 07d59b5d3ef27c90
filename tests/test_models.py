"""Scoring formulas, features and classifiers."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tastegraph.functions import scoring as S
from tastegraph.operators import classifiers, evaluation, features, linear, trees
from tastegraph.operators.scoring import normalize_scores, weigh_reviews
from tastegraph.plans import scoring as plan
from tastegraph.session import ship_package


def test_review_weight(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0.8), (1, 1, 0.8), (-1, 0, -0.8), (-1, 1, -0.8), (-1, 5, 0.0)],
        "review_score int, review_votes int, signed_conf double",
    )
    weights = [round(r.weight, 9) for r in weigh_reviews(rows).collect()]
    assert weights == [1.8, 1.88, -1.8, -1.72, -1.0]


def test_normalized_score_counts_raw_reviews(spark):
    scores = spark.createDataFrame([(1, 40.0), (2, 1.0)], "game_id long, score double")
    reviews = spark.createDataFrame([(1,)] * 20 + [(None,)], "app_id long")
    found = {r.game_id: r.normalized_score for r in normalize_scores(scores, reviews).collect()}
    assert found[1] == pytest.approx(9.0) and found[2] is None


def test_signed_confidence(spark):
    rows = spark.createDataFrame(
        [(0.9, "x"), (0.2, "x"), (0.5, "x"), (0.9, ""), (0.9, None)], "p double, t string"
    )
    found = rows.select(S.signed_confidence(F.col("p"), F.col("t")).alias("c")).collect()
    assert [round(r.c, 9) for r in found] == [0.9, -0.8, -0.5, 0.0, 0.0]


GOOD = ["great fun loved story", "brilliant fun game", "loved great combat", "fun story great"]
BAD = ["awful boring waste", "boring broken refund", "waste money awful", "broken boring awful"]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = []
    for i in range(120):
        text, label = (GOOD[i % 4], 1) if i % 2 else (BAD[(i // 2) % 4], -1)
        rows.append((i, f"{text} common word{i % 7}", label))
    rows.append((120, "", 1))
    return spark.createDataFrame(rows, "review_id long, converted_text string, review_score int")


def test_tfidf(spark, docs):
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=12)
    assert len(vocabulary.terms) == 12 and list(vocabulary.terms) == sorted(vocabulary.terms)
    common = vocabulary.idf[vocabulary.terms.index("common")]
    assert common == pytest.approx(math.log(122 / 121) + 1)
    sparse = features.with_tfidf(docs, vocabulary).collect()
    for row in sparse:
        assert not row.val or sum(v * v for v in row.val) == pytest.approx(1.0)
    assert [r for r in sparse if r.review_id == 120][0].idx == []
    vectors = features.tfidf_vectors(vocabulary).transform(trees.with_terms(docs))
    dense = {r.review_id: r.a for r in vectors.select("review_id", vector_to_array("features").alias("a")).collect()}
    for row in sparse:
        for i, v in zip(row.idx, row.val):
            assert dense[row.review_id][i] == pytest.approx(v)


def test_long_and_sparse_forms_agree(docs):
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=12)
    long = features.tfidf_long(docs, "review_id", vocabulary)
    assert long.count() == sum(len(r.idx) for r in features.with_tfidf(docs, vocabulary).collect())
    counts = features.count_features(docs, "review_id", max_features=12)
    assert {r.term for r in counts.select("term").distinct().collect()} == set(vocabulary.terms)


@pytest.mark.parametrize("kind", ["multinomial_nb", "bernoulli_nb", "gaussian_nb", "sgd", "tree"])
def test_classifiers_separate(docs, kind):
    predicted = plan.evaluate_models(docs, [kind], max_features=50)
    scored = evaluation.classification_metrics(predicted).first()
    assert scored.accuracy > 90
    ends = predicted.agg(F.min("p_positive"), F.max("p_positive")).first()
    assert 0 <= ends[0] < 0.5 < ends[1] <= 1


def test_sgd_does_not_depend_on_partitions(docs):
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=50)
    size = len(vocabulary.terms)
    fits = [
        linear.fit_modified_huber(
            features.with_tfidf(docs.repartition(n), vocabulary), size, rounds=2, epochs=4
        )
        for n in (1, 7)
    ]
    assert fits[0].linear == pytest.approx(fits[1].linear)
    assert fits[0].link == "huber"


def test_tree_and_model_files(spark, docs, tmp_path):
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=50)
    with_terms = trees.with_terms(docs)
    model = trees.fit_decision_tree(with_terms, vocabulary)
    trees.save_model(model, str(tmp_path / "tree"))
    again = trees.predict_tree(with_terms, trees.load_model(str(tmp_path / "tree")))
    assert again.filter("prediction = review_score").count() >= 115
    arrays = features.with_tfidf(docs, vocabulary)
    for fitted in classifiers.fit_naive_bayes(arrays, len(vocabulary.terms), tuple(classifiers.FITTERS)):
        classifiers.save_classifier(spark, fitted, str(tmp_path / fitted.name))
        assert classifiers.load_classifier(spark, str(tmp_path / fitted.name)) == fitted


def test_flat_tree_predicts_like_the_grown_one(spark, docs):
    """Row by row the same class and probability as MLlib gives, on noisy labels and a deep tree."""
    noisy = docs.withColumn("review_score", F.when(F.col("review_id") % 5 == 0, -F.col("review_score")).otherwise(F.col("review_score")))
    noisy = noisy.withColumn("converted_text", F.concat_ws(" ", "converted_text", F.expr("concat('k', (review_id * 7) % 11)")))
    vocabulary = features.fit_vocabulary(noisy, "review_id", max_features=60)
    grown = trees.fit_decision_tree(trees.with_terms(noisy), vocabulary)
    flat = trees.flatten_tree(grown.stages[-1])
    assert flat.depth >= 4 and len(flat.feature) == grown.stages[-1].numNodes
    theirs = trees.predict_tree(trees.with_terms(noisy), grown)
    theirs = {r.review_id: (r.prediction, r.p[1]) for r in theirs.select("review_id", "prediction", vector_to_array("probability").alias("p")).collect()}
    ours = classifiers.predict(features.with_tfidf(noisy, vocabulary), flat).collect()
    assert {r.review_id: (r.prediction, pytest.approx(r.p_positive)) for r in ours} == theirs


def test_scorer_files_serve_another_session(spark, docs, tmp_path):
    vocabulary, model = plan.fit_scorer(docs, "sgd", max_features=50)
    plan.save_scorer(spark, vocabulary, model, str(tmp_path / "scorer"))
    assert plan.load_scorer(spark.newSession(), str(tmp_path / "scorer")) == (vocabulary, model)
    smaller = features.Vocabulary(vocabulary.terms[:-1], vocabulary.idf[:-1])
    smaller.write(spark, str(tmp_path / "scorer" / "vocabulary"))
    with pytest.raises(ValueError, match="terms"):
        plan.load_scorer(spark, str(tmp_path / "scorer"))


def test_benchmark_of_labelled_texts(spark, docs):
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=50)
    models = plan.fit_classifiers(features.with_tfidf(docs, vocabulary), vocabulary, plan.ALL_KINDS)
    texts = spark.createDataFrame(
        [("Great fun, I loved it!", 1), ("boring, awful waste", -1), ("boring and broken", 1), (None, 1), ("x", None), ("y", 3)],
        "text string, expected int",
    )
    predicted = plan.benchmark_texts(texts, vocabulary, models, stem=False, keep=["text"])
    hits = {r.model: (r.hits, r.n) for r in evaluation.labelled_benchmark(predicted).collect()}
    assert len(hits) == 5 and all(n == 4 and 2 <= h <= 3 for h, n in hits.values())
    misses = {r.text for r in evaluation.benchmark_misses(predicted).collect()}
    assert "boring and broken" in misses and "Great fun, I loved it!" not in misses


def test_sentiment_of_raw_text(spark, docs):
    vocabulary, model = plan.fit_scorer(docs, "multinomial_nb", max_features=50)
    texts = spark.createDataFrame(
        [("An awful waste of money",), ("I loved the great story",), ("",), (None,)], "text string"
    )
    scored = plan.execute_sentiment_analysis(texts, vocabulary, model, stem=False)
    negative, positive, empty, null = [r.signed_conf for r in scored.collect()]
    assert negative < -0.5 and positive > 0.5 and empty == 0 and null == 0


def test_metrics_and_benchmark(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, 1.0), ("a", 1, -1, 0.4), ("a", -1, 1, 0.7), ("a", -1, -1, 0.0), ("a", 1, 1, 0.8)],
        "model string, label int, prediction int, p_positive double",
    )
    m = evaluation.classification_metrics(rows).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (66.67, 66.67, 66.67, 60.0)
    cells = {(r.label, r.prediction): r.n for r in evaluation.confusion_matrix(rows).collect()}
    assert cells == {(-1, -1): 1, (-1, 1): 1, (1, -1): 1, (1, 1): 2}
    assert evaluation.labelled_benchmark(rows).first().hits == 3
    assert evaluation.labelled_benchmark(rows, exact=True).first().hits == 2
    assert evaluation.benchmark_misses(rows).count() == 2
    none = evaluation.classification_metrics(rows.filter("label = 5")).first()
    assert none.f1 == 0.0


def test_classes_must_be_known(spark, docs):
    arrays = features.with_tfidf(docs.filter("review_score = 1"), features.fit_vocabulary(docs, "review_id"))
    with pytest.raises(ValueError, match="classes"):
        classifiers.fit_naive_bayes(arrays, 400)


def test_sgd_beats_the_majority_class(spark):
    """On the larger small table, where the rarer class has a chance."""
    import registry

    rows = registry.all_queries()["sgd_modified_huber"](spark, "/root/testdata/sf0.01").collect()
    right = sum(r["label"] == r["prediction"] for r in rows)
    assert right > max(sum(r["label"] == c for r in rows) for c in (-1, 1))


def test_tree_counts_stay_small_in_a_task(docs):
    """A task holds the counts of one group of nodes; four of them share an executor's heap."""
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=12)
    grown = trees.fit_decision_tree(trees.with_terms(docs), vocabulary).stages[-1]
    assert grown.getMaxMemoryInMB() <= 256


def test_terms_are_counted_per_different_token(spark):
    texts = ["aa-bb aa a bb_c", "\u00c9t\u00e9 \u00e9t\u00e9\taa", "", " ", None, "x 1x 1x-aa"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_id long, converted_text string")
    found = {r["term"]: (r["n"], r["df"]) for r in features.term_statistics(docs, "review_id").collect()}
    assert found == {"aa": (4, 3), "bb": (1, 1), "bb_c": (1, 1), "\u00e9t\u00e9": (2, 1), "1x": (2, 1)}
    sparse = features.with_tfidf(docs, features.Vocabulary(("1x", "aa", "bb"), (1.0, 2.0, 1.0)))
    rows = {r["review_id"]: (r["idx"], r["val"]) for r in sparse.collect()}
    assert rows[2] == rows[3] == ([], []) and rows[4] == (None, None) and rows[1] == ([1], [1.0])
    assert rows[0][0] == [1, 2] and rows[0][1] == pytest.approx([4 / 17**0.5, 1 / 17**0.5])
    assert rows[5][0] == [0, 1] and rows[5][1] == pytest.approx([2**-0.5, 2**-0.5])
    # Nothing sorts or counts a text's terms one by one any more.
    plan = sparse._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan and "regexp_extract_all" not in plan


def test_models_store_only_what_they_read(spark):
    from registry import models

    stored = models._converted(spark, "/root/testdata/sf0.001")
    assert stored.columns == ["review_id", "app_id", "review_score", "review_votes", "converted_text"]
