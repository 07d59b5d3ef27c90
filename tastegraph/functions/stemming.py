"""Suffix stripping after Porter (1980), with the usual later refinements.

The stem of a word depends on the word alone, so stemming runs inside each row's
own task: an Arrow batch is split into tokens, only its distinct tokens are
stemmed, and the result is taken back by position. No token is shuffled.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words whose stem the rules would get wrong.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# Suffix tables of steps 2, 3 and 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
    "logi": "log",
}
STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP4 = tuple(
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
)

_CONSONANT_RUN = re.compile("v+c+")


class _Marks(dict):
    """``v`` for the vowels, ``c`` for any other character."""

    def __missing__(self, character: int) -> str:
        return "c"


_MARKS = _Marks({ord(vowel): "v" for vowel in "aeiou"})


def _shape(word: str) -> str:
    """The word as ``c``/``v`` marks; y is a vowel after a consonant."""
    if "y" not in word:
        return word.translate(_MARKS)
    marks = []
    for i, ch in enumerate(word):
        if ch in "aeiou" or (ch == "y" and i > 0 and marks[-1] == "c"):
            marks.append("v")
        else:
            marks.append("c")
    return "".join(marks)


def _measure(word: str) -> int:
    return len(_CONSONANT_RUN.findall(_shape(word)))


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant, or is a two letter vowel-consonant word."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _longest(word: str, suffixes: tuple[str, ...]) -> str | None:
    if not word.endswith(suffixes):
        return None
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len)


def _plurals(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_progressive(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest(word, ("ed", "ing"))
    if ending is None or "v" not in _shape(word[: -len(ending)]):
        return word
    stem = word[: -len(ending)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _replace(word: str, table: dict[str, str]) -> str:
    suffix = _longest(word, tuple(table))
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    counted = stem + "l" if suffix == "logi" else stem
    return stem + table[suffix] if _measure(counted) > 0 else word


def _derivations(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derivations(word[:-2])
    return _replace(word, STEP2)


def _strip(word: str) -> str:
    suffix = _longest(word, STEP4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) < 2 or (suffix == "ion" and stem[-1] not in "st"):
        return word
    return stem


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past_and_progressive(_plurals(word))
    if word.endswith("y") and len(word) > 2 and _shape(word)[-2] == "c":
        word = word[:-1] + "i"
    return _tidy(_strip(_replace(_derivations(word), STEP3)))


# Rows whose tokens are held at a time; a batch may have far more.
STEMMED_ROWS = 1024


def stem_rows(converted: pa.Array) -> pa.Array:
    """Stem every token of space-joined texts."""
    tokens = pc.split_pattern(converted.cast(pa.large_string()), " ")
    coded = tokens.flatten().dictionary_encode()
    stems = pa.array([stem(w) for w in coded.dictionary.to_pylist()], pa.large_string())
    rows = pa.LargeListArray.from_arrays(tokens.offsets.cast(pa.int64()), stems.take(coded.indices))
    joined = pc.binary_join(rows, pa.scalar(" ", pa.large_string()))
    return pc.if_else(converted.is_null(), None, joined).cast(pa.string())


def stem_in_parts(converted: pa.Array) -> pa.Array:
    """The same, a few rows after another."""
    parts = [stem_rows(converted.slice(at, STEMMED_ROWS)) for at in range(0, len(converted), STEMMED_ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(StringType())
def stem_text(converted: pa.Array) -> pa.Array:
    """Stem every token of a space-joined text."""
    return stem_in_parts(converted)
