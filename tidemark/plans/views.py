"""Dashboard questions as DataFrame functions over the gold tables (VIEW-1..10).

All functions are lazy.  Scalars such as "latest hour" are scalar subqueries;
set filters are semi-joins on distinct keys.  Lists come in the dashboard's order (``orderBy``);
the charts that show ten rows carry a ``rank``.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import temporal as TM
from ..functions import text as X
from ..operators.videosets import united

# Dashboard defaults.
DEFAULT_HOURS = 6
DEFAULT_MIN_VIDEOS = 2
TOP_TOPICS = 20
TOP_CHART = 10
LEADERBOARD = 25
CONTRIB_CHART = 10


@dataclass
class WindowFilter:
    """Sidebar state.  ``hours`` for "Last N hours", else ``date_from``/``date_to``
    (local dates, inclusive).  ``langs``/``platforms``: None = all options, [] = no filter."""
    hours: int | None = DEFAULT_HOURS
    date_from: str | None = None
    date_to: str | None = None
    rising_only: bool = True
    min_videos: int = DEFAULT_MIN_VIDEOS
    langs: list[str] | None = None
    platforms: list[str] | None = None
    tz: str = TM.LOCAL_TZ


def last_n_hours(topics: DataFrame, hours: int) -> DataFrame:
    """ts_hour >= latest ts_hour − N hours (inclusive) (FLT-3)."""
    latest = topics.agg(F.max("ts_hour")).scalar()           # scalar subquery, evaluated once
    return _from(topics, latest - F.make_dt_interval(hours=F.lit(hours)))


def _from(topics: DataFrame, start) -> DataFrame:
    """``ts_hour >= start``; a ``date`` partition column gets the matching bound, which prunes folders."""
    if "date" in topics.columns:
        topics = topics.where(F.col("date") >= F.to_date(start))
    return topics.where(F.col("ts_hour") >= start)


def _until(topics: DataFrame, end) -> DataFrame:
    """``ts_hour < end``, likewise."""
    if "date" in topics.columns:
        topics = topics.where(F.col("date") <= F.to_date(end))
    return topics.where(F.col("ts_hour") < end)


def local_date_range(topics: DataFrame, d1: str, d2: str, tz: str = TM.LOCAL_TZ) -> DataFrame:
    """[d1 00:00, d2 + 1 day 00:00) in local time (FLT-4)."""
    start = F.to_utc_timestamp(F.to_timestamp(F.lit(d1)), tz)
    end = F.to_utc_timestamp(F.to_timestamp(F.date_add(F.to_date(F.lit(d2)), 1)), tz)
    return _until(_from(topics, start), end)


def topic_window(topics: DataFrame, videos: DataFrame, f: WindowFilter) -> DataFrame:
    """Filtered topic-hours (VIEW-1): time window, rising, languages, platforms."""
    if f.hours is not None:
        sub = last_n_hours(topics, f.hours)
    else:
        if f.date_from is None or f.date_to is None:
            lo = topics.agg(F.min(TM.to_local("ts_hour", f.tz))).scalar()
            hi = topics.agg(F.max(TM.to_local("ts_hour", f.tz))).scalar()
            start = F.to_utc_timestamp(F.to_timestamp(F.to_date(lo)), f.tz)
            end = F.to_utc_timestamp(F.to_timestamp(F.date_add(F.to_date(hi), 1)), f.tz)
            sub = topics.where((F.col("ts_hour") >= start) & (F.col("ts_hour") < end))
        else:
            sub = local_date_range(topics, f.date_from, f.date_to, f.tz)
    if f.rising_only:
        sub = sub.where(F.col("rising_flag") == 1)
    langs = f.langs
    if langs is None or len(langs) > 0:
        lv = videos.where(F.col("lang").isNotNull() if langs is None else F.col("lang").isin(langs))
        sub = sub.join(lv.select("topic_id").distinct(), "topic_id", "left_semi")
    plats = f.platforms
    if plats is None or len(plats) > 0:
        plat = F.coalesce(F.col("platform"), F.lit("youtube"))
        pv = videos if plats is None else videos.where(plat.isin(plats))
        sub = sub.join(pv.where(F.col("topic_id").isNotNull()).select("topic_id").distinct(), "topic_id", "left_semi")
    return sub


def _last_non_null(c: str) -> F.Column:
    v = F.nullif(F.col(c), F.lit(""))
    return F.max_by(v, F.when(v.isNotNull(), F.col("ts_hour")))


def top_topics(subset: DataFrame, min_videos: int = DEFAULT_MIN_VIDEOS, n: int = TOP_TOPICS) -> DataFrame:
    """Top topics by mean rising score then momentum (VIEW-2, AGG-6, SRT-3, DED-2, JN-8, STR-7)."""
    agg = subset.groupBy("topic_id").agg(
        F.sum("velocity_sum").alias("velocity_sum"),
        F.avg("rising_score").alias("rising_score"),
        F.sum("video_count").alias("video_count"),
        F.sum("channel_count").alias("channel_count"),
        _last_non_null("sample_title").alias("sample_title"),
        _last_non_null("topic_label").alias("topic_label"),
        F.max_by("leader_channels", "ts_hour").alias("leader_channels"),
    )
    top = (agg.where(F.col("video_count") >= min_videos)
           .orderBy(F.desc("rising_score"), F.desc("velocity_sum"), F.asc("topic_id")).limit(n))
    return top.select("topic_id", "topic_label", "sample_title", "leader_channels", "rising_score",
                      "velocity_sum", "video_count", "channel_count",
                      X.display_label("topic_label", "sample_title").alias("label"))


def top_chart(top: DataFrame, n: int = TOP_CHART) -> DataFrame:
    """First rows of the top list with their rank (SRT-4)."""
    return _ranked(top, [F.desc("rising_score"), F.desc("velocity_sum"), F.asc("topic_id")], n)


def _ranked(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows in order, numbered from 1: only those n rows meet in one task."""
    few = df.orderBy(*order).limit(n)
    return few.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


def kpis(subset: DataFrame, video_sets: DataFrame, top: DataFrame) -> DataFrame:
    """Topics in window, videos in the window's hours, top rising score (VIEW-3); videos from ``operators.videosets``."""
    hours = subset.select("ts_hour").distinct()
    return subset.agg(
        F.count_distinct("topic_id").alias("topics_in_window"),
        united(video_sets.join(hours, "ts_hour", "left_semi")).select("videos").scalar().alias("videos_in_window"),
        top.agg(F.max("rising_score")).scalar().alias("top_rising_score"))   # first row of the ordered top list


def selected_topic(top: DataFrame) -> DataFrame:
    """The first topic of the top list (the default selection)."""
    return top.orderBy(F.desc("rising_score"), F.desc("velocity_sum"), F.asc("topic_id")).limit(1).select("topic_id")


def topic_history(subset: DataFrame, topic: DataFrame, tz: str = TM.LOCAL_TZ) -> DataFrame:
    """Momentum over time of the selected topic, by hour (VIEW-4, SRT-8)."""
    h = subset.join(F.broadcast(topic), "topic_id", "left_semi")
    return (h.select("ts_hour", TM.to_local("ts_hour", tz).alias("ts_hour_local"), "velocity_sum", "rising_score")
            .orderBy("ts_hour"))


def topic_videos(subset: DataFrame, videos: DataFrame, topic: DataFrame) -> DataFrame:
    """Videos (rows or sets) of the selected topic within that topic's window hours (JN-7)."""
    keys = subset.join(F.broadcast(topic), "topic_id", "left_semi").select("topic_id", "ts_hour").distinct()
    return videos.join(keys, ["topic_id", "ts_hour"], "left_semi")


def topic_videos_search(tv: DataFrame, q: str = "", literal: bool = False, tz: str = TM.LOCAL_TZ) -> DataFrame:
    """Examples table: optional title search, watch URL, by momentum (VIEW-5, SRT-7)."""
    if q:
        tv = tv.where(X.title_search("title_clean", q, literal=literal))
    return tv.select(TM.to_local("ts_hour", tz).alias("ts_hour_local"), "platform", "channelTitle", "title_clean",
                     "lang", "decayed_velocity", X.watch_url("platform", "videoId").alias("url"), "videoId"
                     ).orderBy(F.desc_nulls_last("decayed_velocity"), F.asc("platform"), F.asc("videoId"))


def platform_mix(topic_sets: DataFrame) -> DataFrame:
    """By momentum (VIEW-6, AGG-7), from the topic's video sets."""
    return (united(topic_sets.where(F.col("platform").isNotNull()), "platform").select("platform", "momentum", F.col("videos").alias("posts"))
            .orderBy(F.desc("momentum"), F.asc("platform")))


def channel_contributions(tv: DataFrame, n: int = CONTRIB_CHART) -> DataFrame:
    """The ``n`` channels that contribute most to the topic (VIEW-7, AGG-8, SRT-6)."""
    by = (tv.where(F.col("channelTitle").isNotNull()).groupBy("channelTitle")
          .agg(F.sum("decayed_velocity").alias("contrib")))
    return _ranked(by, [F.desc("contrib"), F.asc("channelTitle")], n)


def channel_leaderboard(subset: DataFrame, channel_sets: DataFrame, n: int = LEADERBOARD) -> DataFrame:
    """Channels by momentum over the window's hours (VIEW-8, JN-6, AGG-9, SRT-5), from the channels' video sets."""
    hours = subset.select("ts_hour").distinct()
    some = channel_sets.join(hours, "ts_hour", "left_semi").where(F.col("channelTitle").isNotNull())
    board = united(some, "channelTitle").select("channelTitle", "momentum", F.col("videos").alias("posts"))
    return board.orderBy(F.desc("momentum"), F.asc("channelTitle")).limit(n)


def filter_options(topics: DataFrame, videos: DataFrame, tz: str = TM.LOCAL_TZ) -> DataFrame:
    """Sidebar options as (option, value) rows (VIEW-9, DED-3/4, AGG-14)."""
    langs = videos.where(F.col("lang").isNotNull()).select(F.lit("lang").alias("option"), F.col("lang").alias("value")).distinct()
    plats = videos.select(F.lit("platform").alias("option"),
                          F.coalesce(F.col("platform"), F.lit("youtube")).alias("value")).distinct()
    loc = TM.to_local("ts_hour", tz)
    dates = topics.agg(F.min(loc).alias("lo"), F.max(loc).alias("hi"))
    bounds = dates.select(F.inline(F.array(
        F.struct(F.lit("min_local_date").alias("option"), F.date_format("lo", "yyyy-MM-dd").alias("value")),
        F.struct(F.lit("max_local_date").alias("option"), F.date_format("hi", "yyyy-MM-dd").alias("value")))))
    return langs.unionByName(plats).unionByName(bounds).orderBy("option", "value")


def last_updated(topics: DataFrame, tz: str = TM.LOCAL_TZ) -> DataFrame:
    """Latest hour in UTC and local time (VIEW-10)."""
    m = topics.agg(F.max("ts_hour").alias("t"))
    return m.select(F.date_format("t", "yyyy-MM-dd HH:mm").alias("last_utc"),
                    F.date_format(TM.to_local("t", tz), "yyyy-MM-dd HH:mm").alias("last_local"))


def normalize_gold(topics: DataFrame, videos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tolerate older gold tables (PRJ-10, JN-11): derive what a column-less table lacks.

    * ``rising_score`` missing → from ``zscore`` (clip 0..5, scaled to 0..100, 1 dp);
    * ``leader_channels`` missing → recomputed from the videos (top-3 channels per topic-hour);
    * ``topic_label`` missing → the sample title;
    * ``platform`` missing on videos → every video counts as youtube.
    """
    from ..functions import numeric as N
    from ..operators.topics import leader_channels

    if "platform" not in videos.columns:
        videos = videos.withColumn("platform", F.lit("youtube"))
    if "rising_score" not in topics.columns:
        topics = topics.withColumn("rising_score", N.rising_score(F.coalesce(F.col("zscore"), F.lit(0.0))))
    if "leader_channels" not in topics.columns:
        topics = topics.join(leader_channels(videos), ["ts_hour", "topic_id"], "left")
    if "topic_label" not in topics.columns:
        topics = topics.withColumn("topic_label", F.col("sample_title"))
    return topics, videos


def export(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write result tables as CSV folders, e.g. {"top_topics": …, "topic_videos": …} (SNK-7)."""
    import os

    from ..sinks import write_csv
    return {name: write_csv(df, os.path.join(root, name)) for name, df in tables.items()}
