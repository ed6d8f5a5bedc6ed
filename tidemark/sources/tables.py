"""Reading the driver's parquet tables (column pruning and pushdown stay on)."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than cores.

    A single large row group is read by one task, which would serialise all
    per-row work before the first shuffle.  A table of many files and
    row groups has more partitions than cores and stays as it is; rows are the same either way.
    """
    par = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= par else df.repartition(par)


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(spark, df) if spread_rows else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``ts`` is stored without zone (TIMESTAMP_NTZ); the pipeline works in UTC TIMESTAMP.
    return table(spark, sf_dir, "events", spread_rows=True).withColumn("ts", F.col("ts").cast("timestamp"))
