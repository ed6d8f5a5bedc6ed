"""Bronze → silver: flatten, key filter, skew cap, dedup, text, rates, caps, decay."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import parse as P
from ..functions import text as X
from ..functions import temporal as TM
from ..schemas import SILVER_COLS
from .narrow import pick
from .quantile import exact_quantiles

RATE_COLS = ["views_per_min", "likes_per_min", "comments_per_min"]


def flatten(bronze: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested bronze record → flat typed columns (PRJ-1..7).

    ``keep`` lists extra bronze columns to carry along (e.g. an ordering key).
    """
    keep = keep or []
    return bronze.select(
        F.lower(F.coalesce(F.col("platform"), F.lit("youtube"))).alias("platform"),
        P.video_id("id").alias("videoId"),
        P.pick_title("snippet.title", "snippet.localized.title").alias("title"),
        F.col("snippet.description").alias("description"),
        F.col("snippet.channelId").alias("channelId"),
        F.col("snippet.channelTitle").alias("channelTitle"),
        P.lenient_timestamp("snippet.publishedAt").alias("publishedAt"),
        P.lenient_timestamp("_fetched_at").alias("fetchedAt"),
        P.lenient_double("statistics.viewCount").alias("views"),
        P.lenient_double("statistics.likeCount").alias("likes"),
        P.lenient_double("statistics.commentCount").alias("comments"),
        P.iso_duration_seconds("contentDetails.duration").alias("duration_sec"),
        *[F.col(k) for k in keep],
    )


def key_filter(df: DataFrame) -> DataFrame:
    """Drop rows lacking videoId, publishedAt or fetchedAt (FLT-1)."""
    return df.dropna(subset=["videoId", "publishedAt", "fetchedAt"])


def valid_times(silver: DataFrame) -> DataFrame:
    """Rows with both times: what topics are built from (FLT-2)."""
    return silver.dropna(subset=["fetchedAt", "publishedAt"])


def cap_future_publish(df: DataFrame) -> DataFrame:
    """Clock skew: publishedAt = min(publishedAt, fetchedAt) (PRJ-11)."""
    return df.withColumn("publishedAt", F.least("publishedAt", "fetchedAt"))


def dedup_latest(df: DataFrame, keys=("platform", "videoId"), order: list[str] | None = None) -> DataFrame:
    """Latest snapshot per key by fetchedAt; ties by ``order``, then by the other columns (DED-1).

    The rank (``fetchedAt``, ``order``) is aggregated alone and combined map-side, so a hot key (many snapshots of one
    video) is reduced before the shuffle; titles are carried for the picked rows only (``narrow.pick``).  All columns
    take part in the rank at last, so the result does not depend on the partitioning.
    """
    order = list(order or [])
    keys = list(keys)
    tail = [c for c in df.columns if c not in keys and c != "fetchedAt" and c not in order]
    return pick(df, keys, ["fetchedAt", *order], tail)


def text_features(df: DataFrame, lang: Column | None = None) -> DataFrame:
    out = df.withColumn("title_clean", X.collapse_whitespace("title"))
    return out.withColumn("lang", lang if lang is not None else F.lit(None).cast("string"))


def rates(df: DataFrame) -> DataFrame:
    """Null counts → 0; age in fractional minutes with a floor; per-minute rates."""
    out = df.fillna(0.0, subset=["views", "likes", "comments"])
    out = out.withColumn("age_min", N.floor_age(TM.minutes_between("fetchedAt", "publishedAt")))
    return out.withColumns({
        "views_per_min": F.col("views") / F.col("age_min"),
        "likes_per_min": F.col("likes") / F.col("age_min"),
        "comments_per_min": F.col("comments") / F.col("age_min"),
    })


def rate_caps(df: DataFrame, cols=RATE_COLS, q: float = N.CAP_QUANTILE) -> dict[str, float | None]:
    """Global exact ``q`` quantile of each rate (AGG-13)."""
    return exact_quantiles(df, list(cols), q)


def winsorise_rates(df: DataFrame, caps: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: N.winsorise(c, F.lit(caps.get(c)).cast("double")) for c in caps})


def decayed_velocity(df: DataFrame) -> DataFrame:
    return df.withColumn("decayed_velocity", N.decay("views_per_min", "age_min"))


def prepare(bronze: DataFrame, keep: list[str] | None = None, order: list[str] | None = None,
            lang: Column | None = None) -> DataFrame:
    """Everything before the global caps: one row per (platform, videoId)."""
    flat = flatten(bronze, keep=keep)
    flat = cap_future_publish(key_filter(flat))
    ded = dedup_latest(flat, order=order)
    return rates(text_features(ded, lang=lang))


def finish(pre: DataFrame, caps: dict[str, float | None], extra: list[str] | None = None, without: list[str] | None = None) -> DataFrame:
    """The silver columns; ``without`` names those that ``pre`` was written without."""
    out = decayed_velocity(winsorise_rates(pre, caps))
    return out.select(*[c for c in SILVER_COLS if c not in (without or [])], *(extra or []))


def to_silver(bronze: DataFrame, keep: list[str] | None = None, order: list[str] | None = None,
              lang: Column | None = None) -> DataFrame:
    """Bronze → silver in one call.  Runs two small actions for the caps."""
    pre = prepare(bronze, keep=keep, order=order, lang=lang)
    return finish(pre, rate_caps(pre), extra=[k for k in (keep or []) if k not in (order or [])])
