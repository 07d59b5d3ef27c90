"""Helpers that several operators of this package share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.session import free, fresh_path, stage

__all__ = [
    "WORD",
    "components",
    "filter_place",
    "fresh_path",
    "given_back",
    "id_filter",
    "may_hold",
    "plain",
    "read_table",
    "stage",
    "text_key",
]

#: A word, for Spark's and DuckDB's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns ``given_0``, ``given_1``..., and which of them each name became.

    Columns that an operator adds cannot clash with these, whatever the caller's are called;
    ``given_back`` restores the names.
    """
    names = [f"given_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def given_back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The caller's columns alone, under their own names."""
    return rows.select(*[f"given_{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def text_key(column: str = "text") -> Column:
    """Tells rows without or with equal ids apart; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node reachable.

    Alternating star contraction: first the larger neighbours of a node, then the smaller
    ones, are hung on its least neighbour, until nothing moves. The minimum per node is
    summed before the shuffle, and the edges of a node come back by a join, which adaptive
    execution splits; no neighbourhood is gathered in one place.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = stage(large.where("u <> v"), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges, old = stage(small, "edges"), edges
        free(large, old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


FILTER_BITS = 23


def filter_place(column: str) -> Column:
    """Place of an id in an ``id_filter``."""
    return F.shiftrightunsigned(F.xxhash64(F.col(column).cast("long")), 64 - FILTER_BITS)


def id_filter(rows: DataFrame, place: Column, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2**bits places (by default 1 MB, whatever the data) for ``may_hold``.

    Its words are put together by a bit_or per word, so the driver gets 2**(bits - 6) rows at most.
    A full bitmap prunes less; what it lets through is joined exactly afterwards.
    """
    found = (
        rows.select(place.alias("p"))
        .groupBy(F.expr("int(shiftright(p, 6))").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(p & 63)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def may_hold(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the places are set."""
    places = places.astype(np.int64)
    return ((bitmap[places >> 6] >> (places & 63)) & 1).astype(bool)
