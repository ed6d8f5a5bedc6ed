"""Mergeable quantile sketch as plain rows.

A value's bucket is ``ceil(ln x / ln GAMMA)``; a sketch is the number of values per bucket, so sketches
merge by adding counts, in any order and as often as a step is replayed.  A bucket stands for one value that differs
from any of its own by at most ``(GAMMA - 1) / (GAMMA + 1)`` (0.5 %), hence so does a quantile, at every size.  Values up to zero
share one bucket that stands for zero; null, NaN and infinite values are not counted.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAMMA = 1.01
LOW = -(1 << 31)                               # the bucket of values up to zero


def bucket(x: Column) -> Column:
    counted = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.when(counted & (x <= 0), LOW).when(counted, F.ceil(F.ln(x) / math.log(GAMMA)).cast("int"))


def value(b: Column) -> Column:
    return F.when(b == LOW, 0.0).otherwise(F.pow(F.lit(GAMMA), b) * (2.0 / (GAMMA + 1.0)))


def sketches(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """``by..., name, bucket, n``: one sketch per group and column, counted on the map side."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), bucket(F.col(c).cast("double")).alias("bucket")) for c in cols])
    return (df.select(*by, F.explode(pairs).alias("p")).where("p.bucket IS NOT NULL")
            .groupBy(*by, "p.name", "p.bucket").agg(F.count(F.lit(1)).alias("n")))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "name", "bucket").agg(F.sum("n").alias("n"))


def quantile(sketch: DataFrame, by: list[str], per_mille: int) -> DataFrame:
    """``by..., name, bucket, n``: the least bucket that holds ``per_mille`` of the sketch's ``n`` values, or more with those below."""
    group = Window.partitionBy(*by, "name")
    run = sketch.withColumns({"up_to": F.sum("n").over(group.orderBy("bucket")), "all": F.sum("n").over(group)})
    return run.where(F.col("up_to") * 1000 >= F.col("all") * per_mille).groupBy(*by, "name").agg(
        F.min("bucket").alias("bucket"), F.first("all").alias("n"))


def quantiles_before(sketch: DataFrame, order: str, per_mille: int) -> DataFrame:
    """``name, <order>, bucket, n``: for each value of ``order`` the quantile of all sketches before it (null bucket: none).

    Rows whose ``order`` is null come before all others: the merged past.  One group a column; its size is the number of
    buckets times that of the steps, whatever the number of values.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kinds, place = np.unique(pdf["bucket"].to_numpy(), return_inverse=True)
        total, out = np.zeros(len(kinds), np.int64), []
        past = pdf[order].isna().to_numpy()
        np.add.at(total, place[past], pdf["n"].to_numpy()[past])
        pdf = pdf.assign(_place=place)[~past]
        for at, step in pdf.sort_values(order).groupby(order):
            n = int(total.sum())
            found = int(kinds[np.argmax(total.cumsum() * 1000 >= n * per_mille)]) if n else None
            out.append((step["name"].iloc[0], at, found, n))
            np.add.at(total, step["_place"].to_numpy(), step["n"].to_numpy())
        got = pd.DataFrame(out, columns=["name", order, "bucket", "n"])
        return got.astype({"bucket": "Int32"})
    kind = sketch.schema[order].dataType.simpleString()
    return sketch.select("name", order, "bucket", "n").groupBy("name").applyInPandas(run, f"name string, {order} {kind}, bucket int, n long")
