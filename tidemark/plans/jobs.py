"""Batch jobs over files: bronze JSONL → silver → gold, as a user runs them.

    clean_job(spark, bronze_root, silver_path)              # bronze → silver
    topics_job(spark, silver_path, gold_root)               # silver → topics_hourly, videos_with_topics
    load_gold(spark, gold_root)                             # gold tables for plans.views

Each stage writes Parquet (and optionally CSV with header) and returns the
written DataFrame read back, so stages are restartable and lineage is cut.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, langid, topics, videosets
from ..operators.topicmodel import topics as topic_model
from ..schemas import SILVER_COLS, TOPICS_HOURLY, VIDEOS_WITH_TOPICS
from ..sinks import write_csv, write_parquet
from ..session import stage
from ..sources.bronze import FAMILIES, read_bronze, usable


def clean_job(spark: SparkSession, bronze_root: str, silver_path: str, lang_profile: DataFrame | None = None,
              csv_path: str | None = None) -> DataFrame:
    """Bronze files of both families → silver.

    ``lang_profile``: labelled texts (``text``, ``lang``) to train the trigram
    language profile; titles are then labelled with it.  Without it ``lang``
    stays NULL.  An empty bronze gives an empty silver with the full schema.
    """
    bronze = usable(read_bronze(spark, bronze_root))
    # equal fetch times: the later record wins — youtube files before trends files, each by name, lines in file order
    fam = F.lit(0)
    for i, family in enumerate(FAMILIES):
        fam = F.when(F.col("_source_file").contains(family.rstrip("*")), F.lit(i)).otherwise(fam)
    place = ["_family", "_source_file", "_block", "_line"]
    bronze = bronze.withColumn("_family", fam)
    pre = clean.prepare(bronze, keep=place, order=place).drop(*place)
    caps = clean.rate_caps(stage(pre.select(*clean.RATE_COLS), "rates"))     # titles are written once, with the silver
    if lang_profile is not None:
        pre = pre.withColumn("lang", langid.language(spark, langid.train(lang_profile), "title_clean"))
    silver = clean.finish(pre, caps)
    write_parquet(silver, silver_path)
    out = spark.read.parquet(silver_path).select(*SILVER_COLS)
    if csv_path:
        write_csv(out, csv_path)
    return out


def topics_job(spark: SparkSession, silver_path: str, gold_root: str, k: int | None = None,
               partition_by_date: bool = True) -> tuple[DataFrame, DataFrame]:
    """Silver → TF-IDF + k-means topics → gold tables (Parquet, partitioned by date of ts_hour).

    The number of topics, the least document count and the n-grams follow from the number of videos (``topicmodel``), ``k`` unless given.
    An empty silver gives empty gold tables with all columns, a single video topic 0.
    """
    silver = clean.valid_times(spark.read.parquet(silver_path))
    keyed = silver.withColumn("_key", F.concat_ws("\u0001", "platform", "videoId"))
    assigned = stage(topic_model(keyed.select("_key", "title_clean"), "_key", "title_clean", k).drop("distance"), "assigned")
    videos = stage(topics.with_hour(keyed.join(assigned, "_key").drop("_key")), "videos")
    th_path, vt_path = os.path.join(gold_root, "topics_hourly"), os.path.join(gold_root, "videos_with_topics")
    by = ["date"] if partition_by_date else None
    th = topics.topics_hourly(videos).withColumn("date", F.to_date("ts_hour"))
    vt = topics.videos_with_topics(videos).withColumn("date", F.to_date("ts_hour"))
    write_parquet(th if by else th.drop("date"), th_path, by)
    write_parquet(vt if by else vt.drop("date"), vt_path, by)
    numbers = videosets.video_numbers(vt)
    for name, by in (("video_sets", videosets.TOPIC_SET), ("channel_sets", videosets.CHANNEL_SET)):
        write_parquet(videosets.sets(vt, numbers, by), os.path.join(gold_root, name))
    return load_gold(spark, gold_root)


def load_sets(spark: SparkSession, gold_root: str) -> tuple[DataFrame, DataFrame]:
    """(video_sets, channel_sets): partial results of distinct counts, for the KPIs, the platform mix and the leaderboard."""
    return tuple(spark.read.parquet(os.path.join(gold_root, name)) for name in ("video_sets", "channel_sets"))


def load_gold(spark: SparkSession, gold_root: str) -> tuple[DataFrame, DataFrame]:
    """(topics_hourly, videos_with_topics).

    The ``date`` partition column stays: the window filters of ``plans.views`` bound it, which prunes folders.
    """
    return (_gold_table(spark, os.path.join(gold_root, "topics_hourly"), TOPICS_HOURLY),
            _gold_table(spark, os.path.join(gold_root, "videos_with_topics"), VIDEOS_WITH_TOPICS))


def _gold_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A gold table; one that was written without rows has no file below its date folders, hence no schema of its own."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{{*,*/*}}.parquet")
    if pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern):
        return spark.read.parquet(path)
    return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("date", T.DateType())]))
