"""Hand cases of the text functions."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions import stemming
from tastegraph.functions import text as X
from tastegraph.functions.arrays import last_per_id, value_counts
from tastegraph.functions.stemming import stem
from tastegraph.operators import sentences


def _value(spark, text, expression):
    rows = spark.createDataFrame([(text,)], "t string")
    return rows.select(expression(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("Don't stop, it's great!", ["Do", "n't", "stop", ",", "it", "'s", "great", "!"]),
        ("free-to-play 8/10 (1,000 hours)...", ["free-to-play", "8/10", "(", "1,000", "hours", ")", "..."]),
        ('he said "go" -- now', ["he", "said", "``", "go", "''", "--", "now"]),
        ("DON'T", ["DO", "N'T"]),
        ("café naïve_x", ["café", "naïve_x"]),
        ("", []),
    ],
)
def test_tokens(spark, text, tokens):
    assert _value(spark, text, X.tokenize_words) == tokens


def test_punctuation_rule(spark):
    tokens = ["!", "()", "...", "''", "a"]
    rows = spark.createDataFrame([(tokens,)], "t array<string>")
    kept = rows.select(X.remove_punctuation(F.col("t"))).first()[0]
    assert kept == ["...", "''", "a"]


def test_stop_words(spark):
    rows = spark.createDataFrame([(["the", "game", "the", "game"],)], "t array<string>")
    assert rows.select(X.remove_stop_words(F.col("t"))).first()[0] == ["game", "game"]
    assert len(K.PUNCTUATION) == 32
    assert len(set(K.STOP_WORDS)) == len(K.STOP_WORDS)


@pytest.mark.parametrize(
    ("text", "plain"),
    [
        ("Free%20to%20Play", "Free to Play"),
        ("a+b%20c", "a+b c"),
        ("100%", "100%"),
        ("%zz%20", "%zz "),
        ("caf%C3%A9", "café"),
    ],
)
def test_url_unquote(spark, text, plain):
    assert _value(spark, text, X.url_unquote) == plain


def test_counts(spark):
    assert _value(spark, "a♥\U0001f600", X.char_num) == 3
    assert _value(spark, "One. Two! Three?", X.sent_num) == 3
    assert _value(spark, "I can't.", X.word_num) == 4


@pytest.mark.parametrize(
    ("word", "expected"),
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"),
        ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"),
        ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("triplicate", "triplic"),
        ("electrical", "electr"), ("revival", "reviv"), ("adjustment", "adjust"),
        ("adoption", "adopt"), ("probate", "probat"), ("controll", "control"), ("roll", "roll"),
        ("dying", "die"), ("game", "game"), ("playing", "play"), ("as", "as"),
    ],
)
def test_stems(word, expected):
    assert stem(word) == expected


def test_convert_text(spark):
    text = "I really loved playing this game!"
    assert _value(spark, text, X.convert_text) == "realli love play game"
    rows = spark.createDataFrame([(text,), (None,), ("",), ("the !",)], "t string")
    found = [r[0] for r in rows.select(X.convert_text(F.col("t"))).collect()]
    assert found == ["realli love play game", None, "", ""]


def test_array_helpers(spark):
    rows = spark.createDataFrame([(["b", "a", "b"], [1, 2, 3]), ([], [])], "t array<string>, n array<int>")
    counted = rows.select(value_counts(F.col("t")), last_per_id(F.col("t"), F.col("n"))).collect()
    assert [(c["value"], c["n"]) for c in counted[0][0]] == [("a", 1), ("b", 2)]
    assert counted[0][1] == {"a": 2, "b": 3}
    assert counted[1][0] == [] and counted[1][1] == {}


LEARNED = ("dr", "e.g", "z.b", "approx")


@pytest.mark.parametrize(
    ("text", "count"),
    [
        ("Dr. Smith came. He left.", 2),
        ("See e.g. The Manual. It helps.", 2),
        ("J. R. Smith won. Nobody else did!", 2),
        ("Version 3. It is out. Costs 4.5 dollars.", 3),
        ("It has approx. 3. of them and no. more.", 1),
        ('He said "go." Then he left. (Really?) Yes.', 4),
        ("no capital. so what", 1),
        ("One. Two! Three? four", 4),
        ("Das ist z.B. Unsinn. Ja.", 2),
        ("", 0),
        (" \n ", 0),
        ("word", 1),
        (None, None),
    ],
)
def test_sentences_with_learned_abbreviations(spark, text, count):
    expected = 0 if text is None else count
    assert (_value(spark, text, lambda t: sentences.sentence_count(F.coalesce(t, F.lit("")), LEARNED))) == expected


def test_abbreviations_are_learned_from_their_periods(spark):
    """Words that nearly always carry a period, short ones first; not words that end sentences."""
    rows = []
    for i in range(200):
        rows.append(("Dr. Miller saw approx. %d people today. All went on, and today they were well or not well at all. The doctor went home" % i,))
        rows.append(("People like home. It was today, and Mr. Brown (e.g. the doctor) met people today." ,))
    docs = spark.createDataFrame(rows, "t string")
    found = sentences.fit_abbreviations(docs, "t")
    assert {"dr", "mr", "e.g"} <= set(found)
    assert not {"today", "all", "home", "people", "well"} & set(found)
    count = docs.select(sentences.sentence_count(F.col("t"), found).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert tuple(count) == (2, 3)
    assert sentences.fit_abbreviations(docs.limit(0), "t") == ()


def test_stemming_holds_a_few_rows_of_a_batch(monkeypatch):
    held, whole = [], stemming.stem_rows
    monkeypatch.setattr(stemming, "stem_rows", lambda part: held.append(len(part)) or whole(part))
    batch = pa.array([None, "", *[f"running games number{i % 9}" for i in range(5_000)]])
    found = stemming.stem_in_parts(batch)
    assert max(held) <= 1024 and sum(held) == len(batch)
    assert found.to_pylist() == whole(batch).to_pylist() and found[2].as_py() == "run game number0"
    assert stemming.stem_in_parts(batch[:0]).to_pylist() == []


def test_sentence_count_takes_a_text_apart_once(spark):
    texts = ["Hi there. (Go!) on", "a.\u0085 b", "e.g. this. That", "(x)\u0085 \"yes.\" Z.", "no end", " ", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    counted = rows.select("i", sentences.sentence_count(F.col("t"), ("e.g",)).alias("n"))
    assert [r["n"] for r in counted.orderBy("i").collect()] == [3, 1, 2, 2, 1, 0, None]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_words_are_counted_before_they_are_taken_apart(spark):
    rows = spark.createDataFrame([("Dr. (Dr.) dr no;",), ("Dr. No",)], "t string")
    found = sentences.abbreviation_scores(rows, "t").collect()
    assert [(r["type"], r["n"], r["with_period"]) for r in found] == [("dr", 4, 3)]
    grouped = rows.select(F.explode(sentences.words(F.col("t"))).alias("w"))
    bare = grouped.distinct().select("w", sentences.bare(F.col("w")).alias("b")).collect()
    assert {(r["w"], r["b"]) for r in bare} == {("Dr.", "Dr."), ("(Dr.)", "Dr."), ("dr", "dr"), ("no;", "no;"), ("No", "No")}
