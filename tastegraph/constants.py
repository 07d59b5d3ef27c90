"""Fixed values shared by the operators and by the SQL checks."""

from __future__ import annotations

# The English stop words removed before stemming.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Fixed value: the 32 ASCII punctuation characters in code point order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Letters, digits and underscore, spelled out so that every regex engine agrees
# on accented characters (\w does not).
WORD_CHAR = r"[\p{L}\p{N}_]"

# Word tokens. A word may hold inner hyphens, apostrophes, dots and slashes, and a
# comma or colon in front of a digit; an ellipsis, a double dash and the two quote
# marks are tokens; any other visible character stands alone.
TOKEN_PATTERN = (
    r"'?[\p{L}\p{N}_]+(?:[-'./][\p{L}\p{N}_]+|[,:]\p{N}[\p{L}\p{N}_]*)*"
    r"|\.\.\.|--|``|''|[^\s\p{Z}\p{L}\p{N}_]"
)
# Rewrites that come before it: clitics leave their word, quotes become marks.
CLITIC_PATTERN = r"(?i)([\p{L}\p{N}_])(n't|'(?:s|m|d|re|ve|ll))([^\p{L}\p{N}_']|$)"
OPEN_QUOTE_PATTERN = r"(^|[\s\p{Z}(\[{<])\""

SENTENCE_PATTERN = r"[^.!?]+[.!?]*"
# Terms counted by the vectorisers: two or more word characters.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
# What stands between them.
NO_TERM_PATTERN = r"[^\p{L}\p{N}_]+"

SCORER_VOCABULARY = 400
COMPARISON_VOCABULARY = 5000
COUNT_VOCABULARY = 3000
SPLIT_SEED = 34
NORMALISATION_K = 20
SCORE_THRESHOLD = 9.0
TOP_N = 10
EPOCHS = 100
WORDCLOUD_TERMS = 200
