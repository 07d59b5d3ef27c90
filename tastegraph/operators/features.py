"""Term features: vocabulary, counts, TF-IDF, hash split."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions.arrays import value_counts
from tastegraph.functions.text import terms


@dataclass(frozen=True)
class Vocabulary:
    """The kept terms in term order with their inverse document frequencies.

    Its size is the caller's ``max_features``, so it may live on the driver and
    travel with every task.
    """

    terms: tuple[str, ...]
    idf: tuple[float, ...]

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(t, i, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return df.sparkSession.createDataFrame(rows, "term string, idx int, idf double")

    def write(self, spark: SparkSession, path: str) -> None:
        """Save as a table with a row per term."""
        self.table(spark.range(0)).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "Vocabulary":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["idx"])
        return Vocabulary(tuple(r["term"] for r in rows), tuple(r["idf"] for r in rows))


def term_counts(docs: DataFrame, key: str, converted: str = "converted_text") -> DataFrame:
    """(key, term, n) in long form; counting happens inside each row, unshuffled."""
    counted = docs.select(key, F.explode(value_counts(terms(F.col(converted)))).alias("c"))
    return counted.select(key, F.col("c.value").alias("term"), F.col("c.n").alias("n"))


# Rows whose terms are held at a time; a batch may have far more.
COUNTED_ROWS = 1024


def _terms_by_row(converted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, place, n): how often a row of lower case texts has the term at that place of a list.

    The pattern runs once per different token, and terms that tokens share are listed once.
    """
    tokens = pc.split_pattern(converted.cast(pa.large_string()), " ")
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    coded = tokens.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    cells, n = np.unique(np.repeat(np.arange(len(converted)), sizes) * width + coded.indices.to_numpy(), return_counts=True)
    row, token = np.divmod(cells, width)

    pieces = pc.split_pattern_regex(coded.dictionary, K.NO_TERM_PATTERN)
    found = pieces.flatten()
    term = pc.greater_equal(pc.utf8_length(found), 2)
    owner = np.repeat(np.arange(len(pieces)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    owner, listed = owner[term.to_numpy(zero_copy_only=False)], found.filter(term).dictionary_encode()
    many = np.bincount(owner, minlength=width)
    # Each cell becomes as many as its token has terms, and equal ones are added up.
    times, first = many[token], (np.cumsum(many) - many)[token]
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
    width = max(len(listed.dictionary), 1)
    cells, back = np.unique(np.repeat(row, times) * width + listed.indices.to_numpy()[at], return_inverse=True)
    row, place = np.divmod(cells, width)
    return row, place, np.bincount(back, np.repeat(n, times), minlength=len(cells)).astype("int64"), listed.dictionary


def _batch_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n, df) of every few rows of texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, COUNTED_ROWS):
            _, place, n, listed = _terms_by_row(batch.column(0).slice(at, COUNTED_ROWS))
            total = np.bincount(place, n, minlength=len(listed)).astype("int64")
            columns = [listed.cast(pa.string()), pa.array(total), pa.array(np.bincount(place, minlength=len(listed)))]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n", "df"])


def term_statistics(docs: DataFrame, key: str, converted: str = "converted_text") -> DataFrame:
    """Total count and document frequency per term in one map-side combined pass."""
    counts = docs.select(F.lower(converted).alias("c")).mapInArrow(_batch_statistics, "term string, n long, df long")
    return counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def top_terms(docs: DataFrame, key: str, converted: str, max_features: int) -> DataFrame:
    """The ``max_features`` most frequent terms, ties by term."""
    stats = term_statistics(docs, key, converted)
    return stats.orderBy(F.desc("n"), "term").limit(max_features)


def fit_vocabulary(
    docs: DataFrame,
    key: str,
    converted: str = "converted_text",
    max_features: int = K.SCORER_VOCABULARY,
) -> Vocabulary:
    """Fit terms and ``idf = ln((1 + n) / (1 + df)) + 1``."""
    total = docs.count()
    rows = sorted(top_terms(docs, key, converted, max_features).collect(), key=lambda r: r["term"])
    return Vocabulary(
        tuple(r["term"] for r in rows),
        tuple(math.log((1 + total) / (1 + r["df"])) + 1 for r in rows),
    )


def count_features(
    docs: DataFrame,
    key: str,
    converted: str = "converted_text",
    max_features: int = K.COUNT_VOCABULARY,
) -> DataFrame:
    """(key, term, n) over the most frequent terms."""
    kept = top_terms(docs, key, converted, max_features).select("term")
    return term_counts(docs, key, converted).join(F.broadcast(kept), "term").select(key, "term", "n")


def _weigh_terms(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    known, idf = pa.array(vocabulary.terms, pa.string()), np.array(vocabulary.idf, "float64")

    def weigh_rows(texts: pa.Array) -> pa.Array:
        row, place, n, listed = _terms_by_row(texts)
        code = pc.fill_null(pc.index_in(listed.cast(pa.string()), value_set=known), -1).to_numpy()[place]
        hit = code >= 0
        order = np.lexsort((code[hit], row[hit]))
        row, code = row[hit][order], code[hit][order]
        weights = n[hit][order] * idf[code]
        # Sums in term order, as a walk over the row would.
        norms = np.sqrt(np.bincount(row, weights * weights, minlength=len(texts)))
        ends = np.cumsum(np.bincount(row, minlength=len(texts)))
        offsets, missing = pa.array(np.concatenate([[0], ends]), pa.int32()), texts.is_null()
        lists = [pa.array(code, pa.int32()), pa.array(weights / norms[row], pa.float64())]
        lists = [pa.ListArray.from_arrays(offsets, values, mask=missing) for values in lists]
        return pa.StructArray.from_arrays(lists, names=["idx", "val"])

    @F.arrow_udf("idx array<int>, val array<double>")
    def weigh_terms(texts: pa.Array) -> pa.Array:
        starts = range(0, max(len(texts), 1), COUNTED_ROWS)
        return pa.concat_arrays([weigh_rows(texts.slice(at, COUNTED_ROWS)) for at in starts])

    return weigh_terms


def with_tfidf(
    docs: DataFrame, vocabulary: Vocabulary, converted: str = "converted_text"
) -> DataFrame:
    """Add sparse L2-normalised ``idx`` and ``val`` arrays in term order; no shuffle.

    The texts of a few rows are split, counted and weighed together.
    """
    weighed = docs.withColumn("__w", _weigh_terms(vocabulary)(F.lower(converted)))
    return weighed.withColumns({"idx": F.col("__w.idx"), "val": F.col("__w.val")}).drop("__w")


def tfidf_long(
    docs: DataFrame, key: str, vocabulary: Vocabulary, converted: str = "converted_text"
) -> DataFrame:
    """(key, term, weight) in long form."""
    names = F.split(F.lit(" ".join(vocabulary.terms)), " ")
    sparse = with_tfidf(docs.select(key, converted), vocabulary, converted)
    pairs = sparse.select(key, F.explode(F.arrays_zip("idx", "val")).alias("p"))
    return pairs.select(key, F.get(names, F.col("p.idx")).alias("term"), F.col("p.val").alias("weight"))


def tfidf_vectors(vocabulary: Vocabulary, input_col: str = "terms") -> PipelineModel:
    """The same weights as MLlib sparse vectors in column ``features``."""
    counts = CountVectorizerModel.from_vocabulary(
        list(vocabulary.terms), inputCol=input_col, outputCol="term_counts"
    )
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense(vocabulary.idf), inputCol="term_counts", outputCol="term_weights"
    )
    scale = Normalizer(p=2.0, inputCol="term_weights", outputCol="features")
    return PipelineModel([counts, weigh, scale])


def in_test_part(key: Column, seed: int = K.SPLIT_SEED) -> Column:
    """True for about a fifth of the keys: a stable hash split."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % 10 < 2


def train_test_split(
    df: DataFrame, key: str = "review_id", seed: int = K.SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    test = in_test_part(F.col(key), seed)
    return df.filter(~test), df.filter(test)
