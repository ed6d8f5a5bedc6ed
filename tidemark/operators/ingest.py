"""Collector semantics as relational operators (ING-1..13, SET-1..3).

The reference walks an API channel by channel; here a *listing* table
(channelId, videoId, videoPublishedAt) and a *details* table play the API's
part, and each rule becomes a DataFrame step.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import temporal as TM

# Fixed values of the collectors.
DEFAULT_DAYS = 2
INTEREST_DAYS_MOST = 7
TRENDS_CHANNEL_ID = "trends:LK"
TRENDS_CHANNEL_TITLE = "Google Trends (LK)"


def lookback(listing: DataFrame, cutoff: Column | None = None, ts: str = "videoPublishedAt", key: str = "channelId",
             position: str = "position") -> DataFrame:
    """What a walk down each channel's list meets before its first item older than the cutoff (ING-1).

    The list is newest first; the walk ends at the first item known to be older, and all that lies beyond goes, newer items and
    unknown publish times included.  Unknown times before it stay.  Without a cutoff all items stay.

    The end of a channel's walk is an aggregate (one row a channel, combined on the map side), joined back.
    """
    if cutoff is None:
        return listing
    place = F.struct(F.col(position).alias("p"), F.col("videoId").alias("v"))
    ends = listing.where(F.col(ts) < cutoff).groupBy(F.col(key).alias("_channel")).agg(F.min(place).alias("_end"))
    met = listing.join(ends, F.col(key).eqNullSafe(F.col("_channel")), "left")
    return met.where(F.col("_end").isNull() | (place < F.col("_end"))).select(*listing.columns)


def per_channel_cap(listing: DataFrame, cap: int | None = None, key: str = "channelId",
                    position: str = "position") -> DataFrame:
    """First ``cap`` items of each channel's list, before the seen filter (ING-2).

    The list is in upload order, newest first, and ``position`` is an item's place in it, whether or not its
    publish time is known.  Without ``cap`` all items stay.  Top-k per group.
    """
    if cap is None:
        return listing
    w = Window.partitionBy(key).orderBy(F.asc(position), F.asc("videoId"))
    return listing.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")


def skip_seen(listing: DataFrame, seen: DataFrame, key: str = "videoId") -> DataFrame:
    """Ids already fetched in earlier runs are skipped (ING-3, SET-3)."""
    return listing.join(seen.select(key), key, "left_anti")


def advance_seen(seen: DataFrame, fetched: DataFrame, key: str = "videoId") -> DataFrame:
    """New state = seen ∪ fetched ids (ING-4, SET-2)."""
    return seen.select(key).unionByName(fetched.select(key)).distinct()


def resolve_channels(listing: DataFrame, channels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(listing with channel name, configured channels of which ``listing`` has no item at all) (ING-6).

    Pass the whole listing: a channel without anything *new* is resolved.
    """
    ch = channels.select(F.trim("channel_id").alias("channelId"), F.trim(F.coalesce("name", F.lit(""))).alias("channel_name"))
    resolved = listing.join(ch, "channelId", "inner")
    unresolved = ch.join(listing.select("channelId").distinct(), "channelId", "left_anti")
    return resolved, unresolved


def fetch_details(listing: DataFrame, details: DataFrame, key: str = "videoId") -> DataFrame:
    """Ids without a detail record vanish (ING-5)."""
    return listing.join(details, key, "inner")


def stamp(records: DataFrame, fetched_at: Column, platform: str = "youtube") -> DataFrame:
    """Stamp fetch time and platform on every record (ING-7)."""
    return records.withColumns({"_fetched_at": fetched_at, "platform": F.lit(platform)})


def run_manifest(records: DataFrame, run_key: str, channels: DataFrame, file: Column,
                 published_after: Column, fetched_at: Column) -> DataFrame:
    """One summary row per run; ``channels`` = configured channels, not channels with rows (ING-8)."""
    n_ch = channels.agg(F.count("*")).scalar()
    per_run = records.groupBy(run_key).agg(F.count("*").alias("records"))
    return per_run.select(file.alias("file"), "records", n_ch.alias("channels"),
                          published_after.alias("published_after"), fetched_at.alias("fetched_at"))


def unpivot_interest(wide: DataFrame, ts: str = "ts", drop=("isPartial",)) -> DataFrame:
    """Wide (ts × query) interest table → (ts, q, interest); NULL → 0, INT (ING-9)."""
    w = wide.drop(*drop)
    qs = [c for c in w.columns if c != ts]
    long = w.unpivot([ts], qs, "q", "interest")
    return long.withColumn("interest", F.coalesce(F.col("interest"), F.lit(0)).cast("int"))


def last_days(df: DataFrame, days: int | None = None, ts: str = "ts", most: int = INTEREST_DAYS_MOST) -> DataFrame:
    """Rows of the last ``days`` before the latest one, if a number is given (ING-13).

    The interest source serves hours for a week: larger numbers count as ``most``.  Without a number nothing is cut.
    """
    if days is None:
        return df
    return df.where(F.col(ts) >= df.agg(F.max(ts)).scalar() - F.make_dt_interval(days=F.lit(min(days, most))))


def trends_records(long: DataFrame, fetched_at: Column, ts: str = "ts") -> DataFrame:
    """Long interest rows → bronze-shaped records (ING-10..12)."""
    t = F.col(ts).cast("timestamp")         # naive time is taken as UTC (session zone)
    iso = F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return long.select(
        F.lit("trends").alias("platform"),
        F.concat_ws("_", F.lit("trends"), F.col("q"), F.unix_timestamp(t).cast("string")).alias("id"),
        F.struct(
            F.col("q").alias("title"),
            F.concat(F.lit("Google Trends interest for '"), F.col("q"), F.lit("'")).alias("description"),
            F.lit(TRENDS_CHANNEL_ID).alias("channelId"),
            F.lit(TRENDS_CHANNEL_TITLE).alias("channelTitle"),
            iso.alias("publishedAt"),
        ).alias("snippet"),
        F.struct(F.col("interest").alias("viewCount"), F.lit(0).alias("likeCount"), F.lit(0).alias("commentCount")).alias("statistics"),
        fetched_at.alias("_fetched_at"),
    )


def iso_z(c) -> Column:
    return TM.iso_z(c)
