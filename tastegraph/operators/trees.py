"""Decision tree as an MLlib model, walked as an expression, and saving of MLlib models."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.arrays import literal_doubles
from tastegraph.functions.text import terms
from tastegraph.operators import growth
from tastegraph.operators.features import Vocabulary, tfidf_vectors, with_tfidf
from tastegraph.session import fresh_path


def with_terms(docs: DataFrame, converted: str = "converted_text") -> DataFrame:
    return docs.withColumn("terms", terms(F.col(converted)))


def fit_decision_tree(
    train: DataFrame,
    vocabulary: Vocabulary,
    label: str = "review_score",
    max_depth: int = 30,
    seed: int = 34,
) -> PipelineModel:
    """Vectoriser and tree as one saveable model. ``train`` holds ``terms`` arrays.

    Where it holds the vocabulary's ``idx``/``val`` arrays too, those are taken. MLlib wants
    labels from 0, so -1/1 is mapped to 0/1. 30 is the deepest tree it grows. The tree is the
    one that MLlib grows if it looks for cuts among all rows; it does so up to 10,000 and
    samples more. MLlib keeps a number per row and term of the vocabulary, and counts few
    nodes in a pass; ``growth`` does not, so ``seed`` is only noted in the model.
    """
    vectors = tfidf_vectors(vocabulary)
    if not {"idx", "val"} <= set(train.columns):
        train = with_tfidf(train.withColumn("__text", F.array_join("terms", " ")), vocabulary, "__text")
    labelled = train.select(((F.col(label) + 1) / 2).alias("label"), "idx", "val")
    whole = F.when(F.col("label") % 1 == 0, F.col("label").cast("int")).alias("label")
    nodes, cuts = growth.grow(labelled.select(whole, "idx", "val"), len(vocabulary.terms), max_depth)
    tree = DecisionTreeClassifier(maxDepth=max_depth, seed=seed, maxMemoryInMB=256)
    fitted = tree._copyValues(_tree_model(train.sparkSession, nodes, cuts, len(vocabulary.terms)))
    return PipelineModel([*vectors.stages, fitted])


NODE_DATA = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
    "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)


def _tree_model(spark: SparkSession, nodes: growth.Nodes, cuts: np.ndarray, size: int) -> DecisionTreeClassificationModel:
    """MLlib's model of a grown tree, by its file format: a leaf is saved, its nodes are replaced, all is read."""
    jvm, path = spark.sparkContext._jvm, fresh_path(spark, "tree")
    counts = spark.sparkContext._gateway.new_array(jvm.double, 2)
    leaf = jvm.org.apache.spark.ml.tree.LeafNode(0.0, 0.0, jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator(counts, 0))
    uid = DecisionTreeClassifier().uid
    DecisionTreeClassificationModel(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel(uid, leaf, size, 2)).save(path)
    a, b = np.array(nodes.counts, float).T
    impurity = growth.gini(a, b, a + b)
    feature, last, left, right = (np.array(x) for x in (nodes.feature, nodes.bin, nodes.left, nodes.right))
    inner = feature >= 0
    gain = np.full(len(a), -1.0)
    gain[inner] = impurity[inner] - sum((a + b)[x[inner]] / (a + b)[inner] * impurity[x[inner]] for x in (left, right))
    ends = np.concatenate([[0], np.cumsum(inner)])
    cut = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cuts[feature[inner], last[inner]]))
    split = [pa.array(feature, pa.int32()), cut, pa.array(np.full(len(a), -1), pa.int32())]
    split = pa.StructArray.from_arrays(split, ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * 2, pa.int32()), pa.array(np.stack([a, b], axis=1).ravel()))
    rows = pa.table(
        {
            "id": pa.array(np.arange(len(a)), pa.int32()), "prediction": (b > a).astype(float), "impurity": impurity,
            "impurityStats": stats, "rawCount": (a + b).astype(np.int64), "gain": gain,
            "leftChild": pa.array(left, pa.int32()), "rightChild": pa.array(right, pa.int32()), "split": split,
        }
    )
    spark.createDataFrame(rows, NODE_DATA).write.mode("overwrite").parquet(f"{path}/data")
    return DecisionTreeClassificationModel.load(path)


@dataclass(frozen=True)
class TreeClassifier:
    """A binary tree as flat arrays, one place per node; leaves lead to themselves.

    It predicts from a row's own sparse arrays, like the other classifiers, so all of them
    can score in one pass. ``depth`` steps from node 0 end in a leaf.
    """

    name: str
    feature: tuple[int, ...]
    cut: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    positive: tuple[float, ...]
    depth: int

    def p_positive(self, idx: Column, val: Column) -> Column:
        """Share of class 1 among the training rows of the leaf that a row falls into."""
        whole = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")
        feature, left, right = whole(self.feature), whole(self.left), whole(self.right)
        cuts, shares = literal_doubles(self.cut), literal_doubles(self.positive)

        def step(node: Column, _: Column) -> Column:
            place = F.array_position(idx, F.get(feature, node)).cast("int")
            value = F.when(place > 0, F.get(val, place - 1)).otherwise(F.lit(0.0))
            return F.when(value <= F.get(cuts, node), F.get(left, node)).otherwise(F.get(right, node))

        steps = F.array_repeat(F.lit(0), self.depth)
        return F.get(shares, F.aggregate(steps, F.lit(0), step))


def flatten_tree(model: DecisionTreeClassificationModel, name: str = "tree") -> TreeClassifier:
    """The nodes of a fitted tree in the order they are met from the root, by MLlib's file format."""
    spark = SparkSession.active()
    path = fresh_path(spark, "tree")
    model.save(path)
    stored = spark.read.schema(NODE_DATA).parquet(f"{path}/data").select(
        "id", "leftChild", "rightChild", "impurityStats", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", 0).alias("cut")
    )
    rows = stored.toArrow().sort_by("id")
    at, left, right, feature = (rows[c].to_numpy() for c in ("id", "leftChild", "rightChild", "featureIndex"))
    inner = left >= 0
    counts = np.array(rows["impurityStats"].to_pylist())
    total = counts.sum(axis=1)
    return TreeClassifier(
        name,
        tuple(np.where(inner, feature, -1).tolist()),
        tuple(np.where(inner, pc.fill_null(rows["cut"], 0.0).to_numpy(), 0.0).tolist()),
        tuple(np.where(inner, left, at).tolist()),
        tuple(np.where(inner, right, at).tolist()),
        tuple((counts[:, 1] / np.where(total, total, 1.0)).tolist()),
        model.depth,
    )


def fit_tree_classifier(train: DataFrame, vocabulary: Vocabulary, label: str = "review_score", **options) -> TreeClassifier:
    """Grow a tree on converted texts and flatten it."""
    return flatten_tree(fit_decision_tree(with_terms(train), vocabulary, label, **options).stages[-1])


def predict_tree(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``prediction`` as -1 or 1."""
    scored = model.transform(df)
    signed = (F.col("prediction") * 2 - 1).cast("int")
    return scored.withColumn("prediction", signed)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
