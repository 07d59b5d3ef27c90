"""The registered queries against their SQL, and the pipeline on small tables."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, difference
from tastegraph.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, SF_DIR, queries.QUERIES[name], queries.SQL[name], duck) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL) - {"op12_bit_sliced_whitening"}))
def test_query_has_a_row_per_document(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    assert queries.QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_pipeline_stages_and_files(spark):
    """Every stage keeps the columns; the files hold the ids of what the last but one left."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, before = docs.columns, docs.count()
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, SF_DIR), "test")
        assert docs.columns == names
    assert 0 < docs.count() <= 3 * before
    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    start, want = 0, []
    for row in docs.orderBy("doc_id").select("doc_id", "text").collect():
        ids = tokenizer.encode(row["text"], add_special_tokens=False).ids + [2]
        want.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).orderBy("start").collect()
    assert [tuple(r) for r in rows] == want
