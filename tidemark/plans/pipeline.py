"""Medallion pipeline over the driver tables, with materialised layers.

Each layer is written once per session to the shared checkpoint folder
(``spark.checkpoint.dir``) and read back: lineage is cut, a lost executor
only recomputes from the last written layer, and the global rate caps are
computed from a narrow scan of the written table instead of re-running the
join and dedup.  Layers hold no titles: these are most of a record, so they are read from the bronze records again where
a query needs them, by the written places of the picked records (``operators.narrow``).
"""
from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, topics, videosets
from ..operators.textmine import topic_labels
from ..schemas import SILVER_COLS, VIDEOS_WITH_TOPICS_COLS
from ..session import release, scratch_path
from ..sources.fixtures import bronze_from_tables

_lock = threading.RLock()       # held while a layer is built; a layer may build the one below
_written: dict[tuple, str] = {}
_caps: dict[tuple, dict] = {}
_views: dict[tuple, DataFrame] = {}

# Columns that the written silver leaves out.
TEXTS = ["title", "title_clean", "description"]

INPUTS = ("events", "documents")


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the input tables: a changed input gives new layers."""
    out = []
    for t in INPUTS:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((status.getLen(), status.getModificationTime()))
    return tuple(out)


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _stamp(spark, sf_dir), name)


def _materialise(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = _key(spark, sf_dir, name)
    with _lock:
        if key not in _written:
            path = scratch_path(spark, name)
            build().write.mode("overwrite").parquet(path, compression="zstd")
            _written[key] = path
            release(spark)
    return spark.read.parquet(_written[key])


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_tables(spark, sf_dir)


def _picked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (platform, videoId) with rates and titles, before the global caps: a view of the bronze records that were picked."""
    key = _key(spark, sf_dir, "silver_pre")
    with _lock:
        if key not in _views:
            _views[key] = clean.prepare(bronze(spark, sf_dir), keep=["_seq", "_lang", "topic_id"], order=["_seq"], lang=F.col("_lang"))
    return _views[key]


def silver_pre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (platform, videoId) with rates, before the global caps; without texts."""
    return _materialise(spark, sf_dir, "silver_pre", lambda: _picked(spark, sf_dir).drop(*TEXTS, "_lang"))


def with_texts(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the written silver (with ``_seq``, ``platform``, ``videoId``) and their titles and descriptions.

    Texts come from the bronze records of these numbers.  Where several records have one number, they come by key from the picked ones.
    """
    key = _key(spark, sf_dir, "one_record")
    with _lock:
        if key not in _caps:
            pre = silver_pre(spark, sf_dir)
            _caps[key] = bronze_from_tables(spark, sf_dir, of=pre.select("_seq")).count() == pre.count()
    if not _caps[key]:
        return rows.join(_picked(spark, sf_dir).select("platform", "videoId", *TEXTS), ["platform", "videoId"])
    of = {c: f"_of_{c}" for c in rows.columns}
    found = bronze_from_tables(spark, sf_dir, of=rows.select("_seq", *[F.col(c).alias(o) for c, o in of.items()]))
    flat = clean.text_features(clean.flatten(found, keep=[*of.values()]))
    return flat.select(*[F.col(o).alias(c) for c, o in of.items()], *TEXTS)


def caps(spark: SparkSession, sf_dir: str) -> dict:
    key = _key(spark, sf_dir, "caps")
    with _lock:
        if key not in _caps:
            _caps[key] = clean.rate_caps(silver_pre(spark, sf_dir))
    return _caps[key]


def silver_numbers(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ("topic_id",)) -> DataFrame:
    """Silver without its texts, from the written table."""
    return clean.finish(silver_pre(spark, sf_dir), caps(spark, sf_dir), extra=list(extra), without=TEXTS)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver columns plus the adapter's ``topic_id``; whoever needs no text takes ``silver_numbers``, which reads no document."""
    return with_texts(spark, sf_dir, silver_numbers(spark, sf_dir, ("topic_id", "_seq"))).select(*SILVER_COLS, "topic_id")


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without its texts and with each row's hour, for the gold aggregates."""
    return topics.with_hour(silver_numbers(spark, sf_dir, ("topic_id", "_seq")))


def texts(spark: SparkSession, sf_dir: str):
    return lambda rows: with_texts(spark, sf_dir, rows)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialise(spark, sf_dir, "topic_labels", lambda: topic_labels(silver(spark, sf_dir)))


def topics_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialise(spark, sf_dir, "topics_hourly", lambda: topics.topics_hourly(
        hours(spark, sf_dir), labels(spark, sf_dir), texts(spark, sf_dir)))


def videos_with_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection of silver, with titles."""
    return topics.videos_with_topics(silver(spark, sf_dir))


def videos_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without titles."""
    return topics.with_hour(silver_numbers(spark, sf_dir)).select(*[c for c in VIDEOS_WITH_TOPICS_COLS if c not in TEXTS])


ROUND_LIMIT = 1e12


def round_half_away(c, digits: int = 6):
    """sign(x)·floor(|x|·10^d + 0.5)/10^d — the same IEEE operations in every engine.

    (Spark's ``round`` rounds the shortest decimal text, other engines the
    binary value; half-way cases then differ.)  Values beyond 1e12 are left
    as they are.
    """
    x = F.col(c) if isinstance(c, str) else c
    m = float(10 ** digits)
    return F.when(F.abs(x) < ROUND_LIMIT, F.signum(x) * F.floor(F.abs(x) * m + 0.5) / m).otherwise(x)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (engines differ in the last bits of sums/exp)."""
    return df.select(*[round_half_away(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def video_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos per hour, topic, platform and language, as words of 64 bits."""
    return _materialise(spark, sf_dir, "video_sets", lambda: videosets.sets(
        videos_numbers(spark, sf_dir), _numbers(spark, sf_dir), videosets.TOPIC_SET))


def channel_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos per hour and channel."""
    return _materialise(spark, sf_dir, "channel_sets", lambda: videosets.sets(
        videos_numbers(spark, sf_dir), _numbers(spark, sf_dir), videosets.CHANNEL_SET))


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _materialise(spark, sf_dir, "video_numbers", lambda: videosets.video_numbers(videos_numbers(spark, sf_dir)))


KMEANS_ROUNDS = 4        # k-means rounds of the checked queries


def silver_with_kmeans_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without texts (``with_texts`` adds them), with ``topic_id`` from TF-IDF + k-means over titles (the reference's gold flow).

    The number of topics follows from the number of videos; each video is keyed by (platform, videoId) for the join back.
    """
    from ..operators.topicmodel import topics as topic_model

    def build():
        keyed = silver(spark, sf_dir).select(F.concat_ws("\u0001", "platform", "videoId").alias("_key"), "title_clean")
        topics = topic_model(keyed, "_key", "title_clean", rounds=KMEANS_ROUNDS).drop("distance")
        s = silver_numbers(spark, sf_dir, ("_seq",))
        return (s.withColumn("_key", F.concat_ws("\u0001", "platform", "videoId"))
                .join(topics, "_key").drop("_key"))
    return _materialise(spark, sf_dir, "silver_kmeans", build)
