"""Silver → gold: hour buckets, hourly topic aggregates, leaders, rising score."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..functions import temporal as TM
from ..schemas import TOPICS_HOURLY_COLS, VIDEOS_WITH_TOPICS_COLS
from ..session import release, stage
from .narrow import matching
from .textmine import topic_labels

# Fixed value: number of leader channels per topic-hour.
LEADERS_TOP = 3


def with_hour(videos: DataFrame) -> DataFrame:
    return videos.withColumn("ts_hour", TM.hour_bucket("fetchedAt"))


def channel_weights(videos: DataFrame, keys=("ts_hour", "topic_id")) -> DataFrame:
    """Σ decayed_velocity per (keys…, channelTitle); NULL channel dropped (AGG-1)."""
    return (videos.where(F.col("channelTitle").isNotNull())
            .groupBy(*keys, "channelTitle")
            .agg(F.sum("decayed_velocity").alias("weight")))


def leader_channels(videos: DataFrame, keys=("ts_hour", "topic_id"), top: int = LEADERS_TOP) -> DataFrame:
    """Top channels by weight (ties alphabetical), listed alphabetically (AGG-1/4, WIN-1).

    ``row_number() <= top`` is planned as a WindowGroupLimit, so each map task
    forwards at most ``top`` rows per group.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("weight"), F.asc("channelTitle"))
    ranked = channel_weights(videos, keys).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top)
    return ranked.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("channelTitle")), ", ").alias("leader_channels"))


def sample_title_expr() -> F.Column:
    """Last non-empty title in (platform, videoId) order (AGG-3)."""
    ok = F.col("title_clean") != ""
    return F.max_by(F.when(ok, F.col("title_clean")), F.when(ok, F.struct("platform", "videoId")))


def sample_titles(videos: DataFrame, keys=("ts_hour", "topic_id"), texts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``keys..., sample_title``: ids are compared first, so a title is carried for one video per group only.

    ``texts`` gives rows of ``videos`` with ``title_clean``, where they come without.
    """
    keys = list(keys)
    titled = texts or (lambda rows: rows)
    top = stage(titled(videos).where(F.col("title_clean") != "")
                .groupBy(*keys).agg(F.max(F.struct("platform", "videoId")).alias("_top")).select(*keys, "_top.*"), "sample_ids")
    release(videos.sparkSession)
    named = titled(matching(videos, top, [*keys, "platform", "videoId"])).groupBy(*keys).agg(sample_title_expr().alias("sample_title"))
    if texts is not None:
        named = stage(named, "sample_titles", "zstd")
        release(videos.sparkSession)
    every = videos.select(*keys).distinct()
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return every.alias("l").join(named.alias("r"), on, "left").select(*[f"l.{k}" for k in keys], "r.sample_title")


def hourly_aggregate(videos: DataFrame, texts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Σ velocity, distinct videos and channels, sample title per (ts_hour, topic_id) (AGG-2/3).

    Four aggregates on one key, joined: two distinct counts in one would expand
    every row three times, and the title's text would make all of it sort-based.  ``texts`` as for ``sample_titles``.
    """
    keys = ["ts_hour", "topic_id"]
    sums = videos.groupBy(*keys).agg(F.sum("decayed_velocity").alias("velocity_sum"))
    vids = videos.select(*keys, "videoId").distinct().groupBy(*keys).agg(F.count("videoId").alias("video_count"))
    chans = videos.select(*keys, "channelId").distinct().groupBy(*keys).agg(F.count("channelId").alias("channel_count"))
    titles = sample_titles(videos, keys, texts)
    out = sums
    for part in (vids, chans, titles):
        on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        rest = [c for c in part.columns if c not in keys]
        out = out.alias("l").join(part.alias("r"), on).select("l.*", *[f"r.{c}" for c in rest])
    return out


def expanding_baseline(agg: DataFrame, value: str = "velocity_sum", key: str = "topic_id",
                       order: str = "ts_hour") -> DataFrame:
    """z = (v − mean of prior rows) / sample std of prior rows (WIN-3/4, MTH-5..7).

    No prior row → mean 0; fewer than two → std 1; std 0 → 1.  The frame
    counts existing rows (hours without activity are not filled).

    In two levels, so that no task sorts a topic's whole history: rows are reduced to moments per topic and day (count, mean,
    squared deviations, least, largest), the days before are added up per topic (one row a day), and within a day a
    window runs over its own rows; both parts are joined by the rule for merging moments.  Means are kept as
    distances from the topic's first day, which keeps their differences exact enough; equal values are told by least and largest.
    """
    day = agg.withColumn("_day", F.date_trunc("day", F.col(order)))
    daily = day.groupBy(F.col(key).alias("_key"), F.col("_day").alias("_on")).agg(
        F.count(value).alias("_n"), F.avg(value).alias("_mean"), (F.var_pop(value) * F.count(value)).alias("_m2"),
        F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    topic = Window.partitionBy("_key").orderBy("_on")
    before = topic.rowsBetween(Window.unboundedPreceding, -1)
    days = daily.withColumn("_c", F.first("_mean").over(topic.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    gap = F.col("_mean") - F.col("_c")
    days = days.select("_key", "_on", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n1"), F.sum(F.col("_n") * gap).over(before).alias("_s1"),
                       F.sum(F.col("_m2") + F.col("_n") * gap * gap).over(before).alias("_q1"), F.min("_lo").over(before).alias("_lo1"), F.max("_hi").over(before).alias("_hi1"))
    rows = day.join(days, F.col(key).eqNullSafe(F.col("_key")) & F.col("_day").eqNullSafe(F.col("_on")))
    w = Window.partitionBy("_key", "_on").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_n2": F.count(value).over(w), "_a2": F.avg(F.col(value) - F.col("_c")).over(w), "_v2": F.var_pop(value).over(w),
                             "_lo2": F.min(value).over(w), "_hi2": F.max(value).over(w)})
    n1, n2 = F.col("_n1"), F.col("_n2")
    n, a1 = n1 + n2, F.col("_s1") / F.nullif(n1, F.lit(0))
    # a mean of one part alone needs no merging
    shifted = F.when(n2 == 0, a1).when(n1 == 0, F.col("_a2")).otherwise((n1 * a1 + n2 * F.col("_a2")) / n)
    squares = (F.coalesce(F.greatest(F.col("_q1") - F.col("_s1") * a1, F.lit(0.0)), F.lit(0.0)) + F.coalesce(F.col("_v2") * n2, F.lit(0.0))
               + F.when((n1 > 0) & (n2 > 0), F.pow(F.col("_a2") - a1, F.lit(2)) * n1 * n2 / n).otherwise(0.0))
    same = F.least("_lo1", "_lo2") == F.greatest("_hi1", "_hi2")
    sd = F.sqrt(squares / (n - 1))
    sd = F.when((n < 2) | same | (sd == 0), F.lit(1.0)).otherwise(sd)
    mean = F.when(n == 0, F.lit(0.0)).otherwise(F.col("_c") + shifted)
    out = rows.withColumn("zscore", (F.col(value) - mean) / sd).select(*agg.columns, "zscore")
    return out.withColumns({"rising_flag": N.rising_flag("zscore"), "rising_score": N.rising_score("zscore")})


def topics_hourly(videos: DataFrame, labels: DataFrame | None = None, texts: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Gold topic time series, one row per (ts_hour, topic_id) (PRJ-13, JN-2/3); ``texts`` as for ``sample_titles``."""
    v = videos if "ts_hour" in videos.columns else with_hour(videos)
    if labels is None:
        labels = topic_labels(v if texts is None else texts(v))
    agg = hourly_aggregate(v, texts)
    agg = agg.join(leader_channels(v), ["ts_hour", "topic_id"], "left")
    agg = agg.join(labels, "topic_id", "left")       # one row per topic; AQE broadcasts it if it turns out small
    agg = agg.withColumn("topic_label", X.readable_label("topic_label", "sample_title"))
    return expanding_baseline(agg).select(*TOPICS_HOURLY_COLS)


def videos_with_topics(videos: DataFrame) -> DataFrame:
    v = videos if "ts_hour" in videos.columns else with_hour(videos)
    return v.select(*VIDEOS_WITH_TOPICS_COLS)
