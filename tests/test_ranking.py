"""Ordered operators on hot groups, against plain windows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegraph.operators import cleaning, nested, profiling, ranking


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, a third of them in one group."""
    n = F.col("id")
    group = F.when(n % 3 == 0, F.lit(7)).when(n < 20, F.lit(None)).otherwise(n % 50)
    return spark.range(3000).select(
        n, group.cast("long").alias("g"), (F.xxhash64(n) % 97).alias("v")
    )


def test_rank_within_hot_group(hot):
    order = [F.desc("v"), F.col("id")]
    plain = hot.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    ours = ranking.rank_within(hot, ["g"], [-F.col("v"), F.col("id")], "r", ranges=16)
    expected = {(r.id, r.r) for r in plain.collect()}
    assert {(r.id, r.r) for r in ours.collect()} == expected
    direct = ranking.rank_within(hot, ["g"], [-F.col("v"), F.col("id")], "r")
    assert {(r.id, r.r) for r in direct.collect()} == expected


def test_ranges_are_balanced(hot):
    cut = ranking._with_ranges(hot, [F.col("g"), F.col("id")], 16)
    sizes = [r["count"] for r in cut.groupBy(ranking.RANGE).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 3000 / 16


def test_row_ids_are_dense_for_any_range_count(hot):
    for ranges in (1, 5, 40):
        ids = ranking.assign_row_id(hot, [F.desc("v"), F.col("id")][1:], "row", ranges)
        rows = sorted((r["row"], r["id"]) for r in ids.collect())
        assert rows == [(i, i) for i in range(3000)]


@pytest.mark.parametrize("direct", [100_000, 10])
def test_first_rows(hot, direct):
    rows = ranking.first_rows(hot, [F.col("v"), F.col("id")], 500, few=direct).collect()
    expected = sorted((r.v, r.id) for r in hot.collect())[:500]
    assert sorted((r.v, r.id) for r in rows) == expected
    assert ranking.first_rows(hot, [F.col("id")], 9999).count() == 3000
    assert ranking.first_rows(hot, [F.col("id")], 0).count() == 0


def test_sample_is_exact_and_repeatable(hot):
    one = ranking.sample_exact_n(hot, F.col("id"), 321, 5)
    two = ranking.sample_exact_n(hot.repartition(13), F.col("id"), 321, 5)
    ids = {r.id for r in one.collect()}
    assert len(ids) == 321 and ids == {r.id for r in two.collect()}
    other = ranking.sample_exact_n(hot, F.col("id"), 321, 6)
    assert ids != {r.id for r in other.collect()}


def test_first_per_key_prunes_before_the_shuffle(spark, hot):
    first = ranking.first_per_key(hot, ["g"], [F.col("id")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert first.count() == hot.select("g").distinct().count()


def test_describe(spark, hot):
    small = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "x double")
    row = profiling.describe_numeric(small, ["x"]).first()
    assert (row.p25, row.p50, row.p75) == (1.75, 2.5, 4.75)
    assert round(row["std"], 5) == 4.08248
    values = hot.select("g", F.col("v").cast("double").alias("v"))
    found = {r.g: r for r in profiling.describe_numeric(values, ["v"], "g").collect()}
    frame = values.na.drop().toPandas()
    for g, part in frame.groupby("g"):
        assert np.allclose(
            [found[g].p25, found[g].p50, found[g].p75], np.quantile(part.v, [0.25, 0.5, 0.75])
        )


def test_duplicates_and_nulls(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (1, ""), (2, "a"), (2, "a")], "a int, b string")
    assert cleaning.duplicate_count(rows).first()[0] == 2
    assert cleaning.drop_duplicate_rows(rows).count() == 3
    assert {r.column_name: r.nulls for r in cleaning.null_profile(rows).collect()} == {"a": 0, "b": 2}


def test_histogram_of_equal_values(spark):
    rows = spark.createDataFrame([(1, 5.0), (1, 5.0), (-1, 2.0)], "review_score int, x double")
    bins = profiling.histogram_by_class(rows, "x").collect()
    assert {(r.review_score, r.bin, r.n) for r in bins} == {(1, 0, 2), (-1, 0, 1)}


def test_chunked_texts_hold_everything(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("app_id"),
        F.col("id").alias("review_id"),
        F.col("id").cast("string").alias("review_text"),
    )
    chunks = nested.collect_review_texts(rows, chunk=50)
    assert chunks.agg(F.max(F.size("texts"))).first()[0] == 50
    assert chunks.agg(F.sum(F.size("texts"))).first()[0] == 1000
    hot = chunks.filter("app_id = 1").orderBy("chunk").select(F.explode("texts"))
    assert [int(r[0]) for r in hot.collect()][:4] == [0, 1, 3, 6]


def test_pivot_and_unpivot_are_inverse(spark):
    cells = spark.createDataFrame(
        [(10, 0, "a"), (10, 1, "b"), (20, 0, "c"), (20, 1, None)], "app_id long, pos int, category string"
    )
    wide = nested.pivot_tags_wide(cells, [10, 20])
    back = nested.unpivot_cells(wide)
    assert {tuple(r) for r in back.select("app_id", "pos", "category").collect()} == {
        ("10", 0, "a"), ("10", 1, "b"), ("20", 0, "c"), ("20", 1, None)
    }
    lists = {r.app_id: r.categories for r in nested.transpose_tags_nested(cells).collect()}
    assert lists == {10: ["a", "b"], 20: ["c"]}


def test_throughput(hot):
    seen = profiling.throughput(hot, lambda df: df.write.format("noop").mode("overwrite").save())
    assert seen["rows"] == 3000 and seen["rows_per_second"] > 0
