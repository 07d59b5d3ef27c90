"""Sentence counting with abbreviations learned from the texts themselves.

A word that nearly always has a period behind it is an abbreviation. How strongly the two
belong together is the log likelihood ratio of "the period is part of it" (0.99) against
"periods fall as they do everywhere"; short words and words with inner periods count more,
words also seen without the period count less (Kiss and Strunk, 2006). The counts are one
map-side combined sum per word type. Splitting is an expression over a row's own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.arrays import let
from tastegraph.session import stage

# Words are parted by ASCII white space; these may stand before and behind one.
WORDS = r"[^ \t\n\r\f]+"
OPENING = r"^[\"'(\[{«“‘]+"
CLOSING = r"[\"')\]}»”’]+$"
OTHER_ENDS = r"[,;:!?]+$"
#: What a word begins or ends with if the patterns can match; their ``$`` also stands in
#: front of a line end that is no ASCII white space.
LINE_ENDS = "\u0085\u2028\u2029"
OPENERS, CLOSERS, OTHER_LAST = "\"'([{«“‘", "\"')]}»”’" + LINE_ENDS, ",;:!?" + LINE_ENDS
#: Score from which a word is an abbreviation, and the share of periods it is held against.
LEAST_SCORE, OWN_PERIODS = 0.3, 0.99


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), 0)


def bare(word: Column) -> Column:
    """A word without quotes and brackets around it; the patterns run where they can match."""
    opened = F.when(F.left(word, F.lit(1)).isin(*OPENERS), F.regexp_replace(word, OPENING, "")).otherwise(word)
    return F.when(F.right(word, F.lit(1)).isin(*CLOSERS), F.regexp_replace(opened, CLOSING, "")).otherwise(opened)


def abbreviation_scores(docs: DataFrame, text: str) -> DataFrame:
    """(type, n, with_period, score) of every word type that is seen with a period.

    Types are lower case and without the last period; words with digits or without letters
    are none.
    """
    # Words are counted as they stand first, so that each spelling is taken apart once.
    spelled = docs.select(F.explode(words(F.col(text))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    tokens = spelled.select(F.lower(bare(F.col("w"))).alias("w"), "n")
    ended = F.col("w").endswith(".")
    name = F.when(ended, F.expr("substr(w, 1, length(w) - 1)"))
    name = name.when(F.right("w", F.lit(1)).isin(*OTHER_LAST), F.regexp_replace("w", OTHER_ENDS, "")).otherwise(F.col("w"))
    counts = tokens.groupBy(name.alias("type")).agg(
        F.sum("n").alias("n"), F.sum(F.when(ended, F.col("n")).otherwise(0)).alias("with_period")
    )
    counts = stage(counts, "word-types")
    totals = counts.agg(F.sum("n").alias("n"), F.sum("with_period").alias("periods")).first()
    rows = counts.where(F.col("type").rlike(r"\p{L}") & ~F.col("type").rlike(r"\p{N}") & (F.col("with_period") > 0))
    without, own = F.col("n") - F.col("with_period"), F.lit(OWN_PERIODS)
    # All words ending in a period would leave nothing to compare with.
    share = F.lit(min((totals["periods"] or 0) / (totals["n"] or 1), OWN_PERIODS))
    as_always = F.col("with_period") * F.ln(share) + without * F.ln(1 - share)
    as_part = F.col("with_period") * F.ln(own) + without * F.ln(1 - own)
    letters = F.length(F.replace("type", F.lit("."), F.lit("")))
    periods = F.length("type") - letters + 1
    score = 2 * (as_part - as_always) * F.exp(-letters.cast("double")) * periods * F.pow(letters.cast("double"), -without.cast("double"))
    return rows.select("type", "n", "with_period", score.alias("score"))


def fit_abbreviations(docs: DataFrame, text: str, least: float = LEAST_SCORE) -> tuple[str, ...]:
    """The learned abbreviations in order; their number follows the language, not the texts."""
    found = abbreviation_scores(docs, text).where(F.col("score") >= least).select("type")
    return tuple(sorted(r["type"] for r in found.toLocalIterator()))


def sentence_count(text: Column, abbreviations: tuple[str, ...]) -> Column:
    """Sentences of a text: one more than the breaks between its words, 0 without words.

    ``!`` and ``?`` break. A period breaks unless the next word begins in lower case; after
    an initial or an abbreviation it never does, after a number only before a capital that
    is no initial's.
    """
    known = list(abbreviations) or [""]

    def stripped(pair: Column) -> Column:
        return F.struct(bare(pair["word"]).alias("word"), F.regexp_replace(pair["after"], OPENING, "").alias("after"))

    def breaks(pair: Column) -> Column:
        word, after = pair["word"], pair["after"]
        stem = F.lower(F.substring(word, F.lit(1), F.length(word) - 1))
        small = after.rlike(r"^\p{Ll}")
        capital = after.rlike(r"^\p{Lu}") & ~after.rlike(r"^\p{Lu}\.")
        initial = stem.rlike(r"^\p{L}$")
        number = stem.rlike(r"^[\p{N}.,]+$")
        stop = F.when(small | initial | stem.isin(known), False).when(number, capital).otherwise(True)
        return F.when(word.rlike(r"[!?]$"), True).when(word.endswith("."), stop).otherwise(False)

    def count(found: Column) -> Column:
        def ending(word: Column, at: Column) -> Column:
            marked = F.contains(word, F.lit(".")) | F.contains(word, F.lit("!")) | F.contains(word, F.lit("?"))
            return F.when(marked, F.struct(word.alias("word"), F.get(found, at + 1).alias("after")))

        # Words without a mark are most of them and end nothing, so only the rest is taken apart.
        pairs = F.filter(F.transform(found, ending), lambda p: p["after"].isNotNull())
        ends = F.filter(F.transform(pairs, stripped), breaks)
        return F.when(F.size(found) == 0, 0).otherwise(F.size(ends) + 1).cast("int")

    return let(words(text), count)
