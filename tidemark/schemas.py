"""Canonical schemas of the medallion layers."""
from pyspark.sql import types as T

# Bronze as it arrives: every field nullable and textual, so a missing or
# malformed field reads as NULL instead of failing the scan.  ``id`` is
# declared as a string: an object id (search-shaped record) is kept as its
# JSON text and resolved by ``functions.parse.video_id``.
BRONZE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("snippet", T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("channelId", T.StringType()),
        T.StructField("channelTitle", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("localized", T.StructType([T.StructField("title", T.StringType())])),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", T.StringType()),
        T.StructField("likeCount", T.StringType()),
        T.StructField("commentCount", T.StringType()),
    ])),
    T.StructField("contentDetails", T.StructType([T.StructField("duration", T.StringType())])),
    T.StructField("_fetched_at", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

# Column names and order of the silver and gold tables are the output contract.
SILVER_COLS = [
    "platform", "videoId", "channelId", "channelTitle",
    "title", "title_clean", "description", "lang", "duration_sec",
    "publishedAt", "fetchedAt",
    "views", "likes", "comments",
    "age_min", "views_per_min", "likes_per_min", "comments_per_min",
    "decayed_velocity",
]

VIDEOS_WITH_TOPICS = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("videoId", "channelId", "channelTitle", "title_clean", "lang")),
    T.StructField("decayed_velocity", T.DoubleType()),
    T.StructField("ts_hour", T.TimestampType()),
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("platform", T.StringType()),
])

TOPICS_HOURLY = T.StructType([
    T.StructField("ts_hour", T.TimestampType()),
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("topic_label", T.StringType()),
    T.StructField("leader_channels", T.StringType()),
    T.StructField("velocity_sum", T.DoubleType()),
    T.StructField("video_count", T.LongType()),
    T.StructField("channel_count", T.LongType()),
    T.StructField("zscore", T.DoubleType()),
    T.StructField("rising_flag", T.IntegerType()),
    T.StructField("rising_score", T.DoubleType()),
    T.StructField("sample_title", T.StringType()),
])

TOPICS_HOURLY_COLS = TOPICS_HOURLY.names
VIDEOS_WITH_TOPICS_COLS = VIDEOS_WITH_TOPICS.names
