"""Bipartite channel–topic network: weighted degree of both node sets (ML-8)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(videos: DataFrame) -> DataFrame:
    """(channelTitle, topic_id, weight = Σ decayed_velocity); NULL ends dropped."""
    return (videos.where(F.col("channelTitle").isNotNull() & F.col("topic_id").isNotNull())
            .groupBy("channelTitle", "topic_id").agg(F.sum("decayed_velocity").alias("weight")))


def channel_strength(e: DataFrame) -> DataFrame:
    """Channels by weight (SRT-9)."""
    return e.groupBy("channelTitle").agg(F.sum("weight").alias("weight")).orderBy(F.desc("weight"), F.asc("channelTitle"))


def topic_strength(e: DataFrame) -> DataFrame:
    """Topics by weight (SRT-9)."""
    return e.groupBy("topic_id").agg(F.sum("weight").alias("weight")).orderBy(F.desc("weight"), F.asc("topic_id"))
