"""Corpus pipeline: the stages that turn documents into token files.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept,
with all their columns. Rows with null columns, empty texts, repeated rows and extra
columns follow the rules that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastegraph.llm import decontaminate, mixing, ngram_join, quality_sampling, token_files
from tastegraph.llm.common import fresh_path, read_table, stage
from tastegraph.llm.queries import vocabulary
from tastegraph.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance weight stay; junk and toxic ones go."""
    ship_package(spark)
    return quality_sampling.keep(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    ship_package(spark)
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix takes it."""
    ship_package(spark)
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document where its ids stand in them."""
    ship_package(spark)
    path = fresh_path(spark, "token-files")
    token_files.write_files(docs, path, vocabulary("word_bpe_49k.json"))
    return token_files.read_files(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", tokens),
]

#: A fitted model, random draws and a tokenizer's library are beyond SQL; tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "".join(c if c.isalnum() else "-" for c in name))
    return STAGES[-1][1](spark, docs, sf_dir)
