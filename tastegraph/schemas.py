"""Declared schemas: batch tables and the three message kinds."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_TABLE = T.StructType(
    [
        T.StructField("app_id", T.LongType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("review_score", T.IntegerType()),
        T.StructField("review_votes", T.IntegerType()),
    ]
)

SCORE_TABLE = T.StructType(
    [T.StructField("game_id", T.LongType()), T.StructField("score", T.DoubleType())]
)

# Wire formats; ids travel as strings.
REVIEW_MESSAGE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("app_id", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("sentiment_target", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("converted_text", T.StringType()),
    ]
)

TAG_MESSAGE = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
    ]
)

PLAYTIME_FIELDS = [
    "playtime_forever",
    "playtime_windows_forever",
    "playtime_mac_forever",
    "playtime_linux_forever",
    "rtime_last_played",
    "playtime_disconnected",
]

OWNED_GAME = T.StructType(
    [T.StructField("appid", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in PLAYTIME_FIELDS]
)

USER_GAMES_MESSAGE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("games", T.ArrayType(OWNED_GAME)),
    ]
)

# One landed answer of the owned-games service.
OWNED_GAMES_RESPONSE = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("response", T.StructType([T.StructField("games", T.ArrayType(OWNED_GAME))])),
    ]
)

# Records of the file-backed topic: the columns of a broker source that we use.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
# Where a message stood. Offsets count within a partition, so time comes first.
PLACE = ("timestamp", "partition", "offset")
