"""Text expressions. All run inside the JVM except stemming (see stemming.py)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegraph import constants as K
from tastegraph.functions.stemming import stem_text


def lower(text: Column) -> Column:
    return F.lower(text)


def tokenize_words(text: Column) -> Column:
    """Word tokens in order; clitics and quote marks are tokens of their own.

    The rewrites only run on texts that hold the character they are about.
    """
    apart = F.regexp_replace(text, K.CLITIC_PATTERN, "$1 $2 $3")
    spaced = F.when(F.contains(text, F.lit("'")), apart).otherwise(text)
    opened = F.regexp_replace(spaced, K.OPEN_QUOTE_PATTERN, "$1 `` ")
    closed = F.replace(opened, F.lit('"'), F.lit(" '' "))
    quoted = F.when(F.contains(text, F.lit('"')), closed).otherwise(spaced)
    return F.regexp_extract_all(quoted, F.lit(K.TOKEN_PATTERN), 0)


def remove_stop_words(tokens: Column, stop_words=K.STOP_WORDS) -> Column:
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(words))


def remove_punctuation(tokens: Column) -> Column:
    """Drop tokens that are a contiguous piece of the punctuation characters."""
    return F.filter(tokens, lambda t: F.position(t, F.lit(K.PUNCTUATION)) == 0)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def content_tokens(tokens: Column) -> Column:
    """Drop stop words and punctuation from lowercase tokens in one filter pass."""
    words = list(K.STOP_WORDS)
    return F.filter(
        tokens, lambda t: ~t.isin(words) & (F.position(t, F.lit(K.PUNCTUATION)) == 0)
    )


def convert_tokens(tokens: Column, stem: bool = True) -> Column:
    joined = join_tokens(content_tokens(tokens))
    return stem_text(joined) if stem else joined


def convert_text(text: Column, stem: bool = True) -> Column:
    """Review text to the space-joined terms the classifiers read."""
    return convert_tokens(tokenize_words(F.lower(text)), stem)


def char_num(text: Column) -> Column:
    return F.length(text)


def word_num(text: Column) -> Column:
    return F.size(tokenize_words(text))


def sent_num(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(K.SENTENCE_PATTERN), 0))


def extract_links(html: Column, pattern: str, group: int = 2) -> Column:
    """Every match of one capture group, in page order, repeats kept."""
    return F.regexp_extract_all(html, F.lit(pattern), group)


def url_unquote(text: Column) -> Column:
    """Percent-decode; ``+`` and percent signs without two hex digits stay."""
    safe = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def terms(converted: Column) -> Column:
    """The terms a vectoriser counts: two or more word characters, lowercased."""
    return F.regexp_extract_all(F.lower(converted), F.lit(K.TERM_PATTERN), 0)


def is_missing(text: Column) -> Column:
    """Null and empty text both count as missing."""
    return text.isNull() | (text == "")


def missing_text_guard(text: Column, value: Column) -> Column:
    return F.when(is_missing(text), F.lit(0.0)).otherwise(value)
