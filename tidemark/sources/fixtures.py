"""Adapters that derive reference-shaped inputs from the driver tables.

``events`` + ``documents`` become nested bronze records: a channel per user,
24 topics from ``props.k``, 4,000 video ids (so snapshots repeat and dedup is
exercised), and the messy shapes the cleaner must survive: object ids, empty
titles with a localized fallback, three timestamp spellings, unparsable
timestamps and counts, missing platform, future publishes, ISO durations.
The title of a video is the whole document text.

Every rule here is mirrored in ``plans.sql`` so DuckDB can check the result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import events, table

# Fixed values of the adapter (mirrored in plans/sql.py): 2 video ids per
# 5 events (so snapshots repeat and dedup has work at every scale), 24 topics.
VIDEOS_PER_EVENT = (2, 5)
N_TOPICS = 24

_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def n_videos(ev: DataFrame) -> F.Column:
    """Size of the video id space (2 ids per 5 events), as a scalar subquery."""
    a, b = VIDEOS_PER_EVENT
    return ev.agg(F.greatest(F.lit(1).cast("long"), (F.count("*") * a / b).cast("long"))).scalar()


def _vid(eid: F.Column) -> F.Column:
    """``vid`` + the id number padded to 8 digits (11 characters) or longer unpadded."""
    num = (eid % F.col("_nv")).cast("string")
    return F.concat(F.lit("vid"), F.when(F.length(num) >= 8, num).otherwise(F.lpad(num, 8, "0")))


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def bronze_from_tables(spark: SparkSession, sf_dir: str, only: F.Column | None = None, of: DataFrame | None = None) -> DataFrame:
    """Nested bronze (schema of ``schemas.BRONZE``) plus ``_seq``, ``_lang``, ``topic_id``.

    ``only``: a condition on ``events``, applied before the documents join.  ``of``: rows with ``_seq``; the records of these numbers
    are read alone, each with its row's other columns, likewise joined before the documents.
    """
    ev = events(spark, sf_dir)
    docs = table(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text", "lang", "source")
    # counts are scalar subqueries evaluated once; the join key is projected
    # first (a subquery inside the join condition itself is not supported)
    n_docs = docs.agg(F.count("*")).scalar()
    ev = ev.withColumns({"_nv": n_videos(ev), "_doc": F.col("event_id") % n_docs})
    if only is not None:
        ev = ev.where(only)
    if of is not None:
        ev = ev.join(of, ev["event_id"] == of["_seq"]).drop("_seq")
    e = ev.join(docs, ev["_doc"] == docs["doc_id"], "inner")

    eid = F.col("event_id")
    k = _k()
    vid = _vid(eid)
    ident = (F.when(eid % 331 == 0, F.lit('{"kind": "youtube#searchResult"}'))
              .when(eid % 7 == 3, F.to_json(F.struct(vid.alias("videoId"))))
              .otherwise(vid))
    platform = (F.when(F.col("event_type") == "signup", F.lit("Trends"))
                 .when(F.col("event_type") == "error", F.lit(None).cast("string"))
                 .otherwise(F.lit("YouTube")))
    title = (F.when(eid % 50 == 0, F.lit(None).cast("string"))
              .when(eid % 50 == 25, F.lit(""))
              .otherwise(F.col("text")))
    localized = F.when(eid % 4 < 2, F.struct(F.concat(F.col("source"), F.lit(" "), F.col("text")).alias("title")))
    pub = F.when(eid % 1009 == 0, F.col("ts") + F.expr("INTERVAL 3 MINUTES")) \
           .otherwise(F.col("ts") - F.make_dt_interval(mins=k + 1))
    pub_txt = (F.when(eid % 211 == 0, F.lit("not-a-time"))
                .when(eid % 3 == 0, F.concat(F.date_format(pub, _MICRO), F.lit("Z")))
                .when(eid % 3 == 1, F.concat(F.date_format(pub, _MICRO), F.lit("+00:00")))
                .otherwise(F.concat(F.date_format(pub + F.expr("INTERVAL '05:30' HOUR TO MINUTE"), _MICRO),
                                    F.lit("+05:30"))))
    fetched_txt = F.when(eid % 97 == 0, F.lit(None).cast("string")) \
                   .otherwise(F.concat(F.date_format("ts", _MICRO), F.lit("Z")))
    value = F.col("value")
    duration = (F.when(k % 5 == 0, F.concat(F.lit("PT"), k.cast("string"), F.lit("M"), (k % 60).cast("string"), F.lit("S")))
                 .when(k % 5 == 1, F.concat(F.lit("P"), (k % 3).cast("string"), F.lit("DT"), (k % 24).cast("string"), F.lit("H")))
                 .when(k % 5 == 2, F.lit("P"))
                 .when(k % 5 == 3, F.concat(F.lit("PT"), k.cast("string"), F.lit("S")))
                 .otherwise(F.concat(F.lit("bad"), k.cast("string"))))
    return e.select(
        ident.alias("id"),
        platform.alias("platform"),
        F.struct(
            title.alias("title"),
            F.concat(F.lit("Interest in "), F.col("source")).alias("description"),
            F.concat(F.lit("UC"), F.col("user_id").cast("string")).alias("channelId"),
            F.when(eid % 61 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Channel "), F.col("user_id").cast("string"))).alias("channelTitle"),
            pub_txt.alias("publishedAt"),
            localized.alias("localized"),
        ).alias("snippet"),
        F.struct(
            (value * 100).cast("string").alias("viewCount"),
            F.when(eid % 13 == 0, F.lit("n/a")).otherwise(value.cast("string")).alias("likeCount"),
            F.when(eid % 10 == 0, F.lit(None).cast("string")).otherwise((value / 10).cast("string")).alias("commentCount"),
        ).alias("statistics"),
        F.struct(duration.alias("duration")).alias("contentDetails"),
        fetched_txt.alias("_fetched_at"),
        F.lit(None).cast("string").alias("_corrupt"),
        eid.alias("_seq"),
        F.col("lang").alias("_lang"),
        (k % N_TOPICS).cast("int").alias("topic_id"),
        *([] if of is None else [c for c in of.columns if c != "_seq"]),
    )


# ---------------------------------------------------------------- collector-side tables


def listing_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upload listing: one item per event; a channel per user; some publish times unknown; newest first."""
    ev = events(spark, sf_dir)
    ev = ev.withColumn("_nv", n_videos(ev))
    return ev.select(
        F.concat(F.lit("UC"), F.col("user_id").cast("string")).alias("channelId"),
        _vid(F.col("event_id")).alias("videoId"),
        F.when(F.col("event_id") % 89 == 0, F.lit(None).cast("timestamp")).otherwise(F.col("ts")).alias("videoPublishedAt"),
        (-F.col("event_id")).alias("position"))


def seen_from_tables(spark: SparkSession, sf_dir: str, before: F.Column) -> DataFrame:
    """Ids fetched by earlier runs: viewed items older than the lookback cutoff."""
    ev = events(spark, sf_dir)
    ev = ev.withColumn("_nv", n_videos(ev))
    return ev.where((F.col("event_type") == "view") & (F.col("ts") < before)).select(_vid(F.col("event_id")).alias("videoId")).distinct()


def details_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail lookup: latest statistics per id; ids only seen in error events have none."""
    ev = events(spark, sf_dir)
    ev = ev.withColumn("_nv", n_videos(ev)).where(F.col("event_type") != "error")
    return ev.groupBy(_vid(F.col("event_id")).alias("videoId")).agg(F.max_by(F.col("value") * 100, "event_id").alias("views"))


def channels_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured channels (name, channel_id) from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_name").alias("name"), F.concat(F.lit("UC"), F.col("c_custkey").cast("string")).alias("channel_id"))


def trends_wide_from_tables(spark: SparkSession, sf_dir: str, days: int | None = None) -> DataFrame:
    """Wide hourly interest table (ts, one column per query found in the data, isPartial)."""
    from ..operators.ingest import last_days
    ev = events(spark, sf_dir).select(F.date_trunc("hour", "ts").alias("ts"), "event_type").where(F.col("event_type").isNotNull())
    wide = last_days(ev, days).groupBy("ts").pivot("event_type").agg(F.count(F.lit(1)))
    return wide.withColumn("isPartial", F.col("ts") == ev.agg(F.max("ts")).scalar())
