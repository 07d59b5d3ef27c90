"""Projection, filtering, null and duplicate handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.operators.ranking import sample_exact_n

REVIEW_COLUMNS = ("app_id", "app_name", "review_score", "review_text")


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (all columns by default)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def split_by_repeats(df: DataFrame, columns: Sequence[str], digest: str = "__digest") -> tuple[DataFrame, DataFrame]:
    """(alone, repeated): rows whose digest no other row has, and the rest, dealt by digest.

    Only digests are counted through a shuffle. Rows that are alone stay where they are if
    the repeated digests are few enough to be sent round, which adaptive execution decides
    by their size; of the others each group of copies meets in the task of its digest. Two
    different rows with one digest end up among the repeated ones, where whole rows are
    compared, so the split is exact whatever the digests.
    """
    keyed = df.withColumn(digest, F.xxhash64(*columns))
    counts = keyed.groupBy(digest).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.where("n > 1").select(digest)
    alone = keyed.join(repeated, digest, "left_anti").drop(digest)
    return alone, keyed.join(repeated, digest, "left_semi").repartition(digest)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; digests find the rows that have copies, and only those meet."""
    alone, repeated = split_by_repeats(df, df.columns)
    return alone.unionByName(repeated.dropDuplicates().drop("__digest"))


def row_digest(columns: Sequence[str]) -> Column:
    """256-bit digest of a row; JSON keeps field borders and nulls apart."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column in one pass."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Only digests are shuffled, not the rows."""
    copies = df.groupBy(row_digest(df.columns).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, null included."""
    return df.select(column).distinct()


def filter_class(df: DataFrame, label: int, column: str = "review_score") -> DataFrame:
    return df.filter(F.col(column) == label)


def filter_threshold(
    df: DataFrame, threshold: float = K.SCORE_THRESHOLD, column: str = "normalized_score"
) -> DataFrame:
    """Strictly above the threshold."""
    return df.filter(F.col(column) > F.lit(float(threshold)))


def positional_lookup(numbered: DataFrame, positions: DataFrame, on: str = "id") -> DataFrame:
    """Rows of a numbered table at the given positions."""
    return numbered.join(positions.select(on).distinct(), on, "left_semi")


def cast_key(df: DataFrame, column: str) -> DataFrame:
    """String id to BIGINT; an unparsable id becomes null."""
    return df.withColumn(column, F.expr(f"try_cast(`{column}` AS BIGINT)"))


def prune_null_items(items: Column) -> Column:
    return F.array_compact(items)


def clean_reviews(
    df: DataFrame,
    n: int | None = None,
    key: str = "review_id",
    seed: int = K.SPLIT_SEED,
    subset: Sequence[str] = REVIEW_COLUMNS,
) -> DataFrame:
    """Drop nulls, sample exactly ``n`` (optional), then drop repeated rows."""
    kept = drop_null_rows(df, subset)
    if n is not None:
        kept = sample_exact_n(kept, F.col(key), n, seed)
    return drop_duplicate_rows(kept.select(*subset))


def distinct_reviews(
    df: DataFrame, key: str = "review_id", subset: Sequence[str] = (*REVIEW_COLUMNS, "review_votes")
) -> DataFrame:
    """Reviews without nulls and repeats, each under the lowest id of its copies."""
    kept = drop_null_rows(df, subset).select(key, *subset)
    alone, repeated = split_by_repeats(kept, subset)
    firsts = repeated.groupBy("__digest", *subset).agg(F.min(key).alias(key))
    return alone.unionByName(firsts.select(key, *subset))
