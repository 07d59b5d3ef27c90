"""The decision tree on sparse rows against MLlib's."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tastegraph.operators import features, growth, trees
from tastegraph.session import ship_package


@pytest.fixture(scope="module")
def docs(spark):
    """Texts of several lengths with noisy labels, empty ones and repeated ones among them."""
    ship_package(spark)
    draw = np.random.default_rng(7)
    rows = []
    for i in range(400):
        n = int(draw.integers(0, 40))
        words = [f"w{int(x)}" for x in np.minimum(draw.zipf(1.4, n), 60)]
        good = sum(len(w) == 2 for w in words) > n / 2
        rows.append((i, " ".join(words), 1 if good ^ (draw.random() < 0.2) else -1))
    rows += [(400 + i, rows[i][1], rows[i][2]) for i in range(50)]
    return spark.createDataFrame(rows, "review_id long, converted_text string, review_score int")


@pytest.mark.parametrize("alone, together", [(growth.ALONE, growth.TOGETHER), (800, 3), (0, 8)])
def test_tree_is_the_one_of_mllib(docs, monkeypatch, alone, together):
    """Whether one task grows it, or many count for the upper nodes, or for all."""
    monkeypatch.setattr(growth, "ALONE", alone)
    monkeypatch.setattr(growth, "TOGETHER", together)
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=50)
    depth = 30 if alone else 4
    vectors = features.tfidf_vectors(vocabulary).transform(trees.with_terms(docs))
    labelled = vectors.withColumn("label", (F.col("review_score") + 1) / 2)
    theirs = DecisionTreeClassifier(maxDepth=depth, seed=34).fit(labelled)
    ours = trees.fit_decision_tree(trees.with_terms(docs), vocabulary, max_depth=depth).stages[-1]
    assert ours.toDebugString.split("\n")[1:] == theirs.toDebugString.split("\n")[1:]
    flat, again = trees.flatten_tree(ours), trees.flatten_tree(theirs)
    assert flat == again and flat.depth >= 4 and len(flat.feature) == theirs.numNodes
    featured = trees.fit_tree_classifier(features.with_tfidf(docs, vocabulary), vocabulary, max_depth=depth)
    assert featured == flat


def test_cuts_are_next_to_equal_shares():
    """Against a walk over the values, as MLlib takes it."""
    draw = np.random.default_rng(3)
    for rows in (1, 5, 40, 700, 5000):
        for share in (0.05, 0.6, 1.0):
            values = np.round(draw.random(max(1, int(rows * share))) ** 3, 3) + 0.001
            bins = min(growth.BINS, rows)
            listed = np.concatenate([values, np.zeros(rows - len(values))])
            found, counts = np.unique(listed, return_counts=True)
            if len(found) <= bins:
                wanted = [(a + b) / 2 for a, b in zip(found, found[1:])]
            else:
                wanted, seen, target = [], counts[0], rows / bins
                for i in range(1, len(found)):
                    before, seen = seen, seen + counts[i]
                    if abs(before - target) < abs(seen - target):
                        wanted.append((found[i - 1] + found[i]) / 2)
                        target += rows / bins
            assert growth.cut_points(values, rows, bins).tolist() == wanted and len(wanted) < max(bins, 2)


def test_upper_nodes_are_counted_in_groups(docs, monkeypatch):
    """Passes follow the large nodes, not all nodes, and labels other than -1 and 1 are refused."""
    monkeypatch.setattr(growth, "ALONE", 1500)
    passes, counted = [], growth._counted
    monkeypatch.setattr(growth, "_counted", lambda *a: passes.append(len(a[2])) or counted(*a))
    vocabulary = features.fit_vocabulary(docs, "review_id", max_features=50)
    arrays = features.with_tfidf(docs, vocabulary)
    flat = trees.fit_tree_classifier(arrays, vocabulary)
    assert 0 < len(passes) < 12 and sum(passes) < len(flat.feature) / 4
    with pytest.raises(ValueError):
        trees.fit_tree_classifier(arrays.withColumn("review_score", F.lit(0)), vocabulary)
