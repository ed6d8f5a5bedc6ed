"""Pick rows by their narrow columns first, and carry wide ones (titles) for the picked rows only.

A ``max_by`` aggregate over whole rows shuffles and sorts every title, for each snapshot.  Here the rank alone is
aggregated; the rows that hold it follow by semi-joins, which Spark moves below a projection or a join where the keys
allow it.  Where they stay on wide rows, a bitmap of fixed size drops most others before the exchange.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release, stage

# 4096 words of 32768 bits, 16 MB in all.
WORDS, WORD_BITS = 4096, 32768


def matching(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``on`` columns are a row of ``wanted`` (nulls are equal); ``wanted`` should be written."""
    named = wanted.select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(on)])
    at = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(WORDS * WORD_BITS))
    place = at([F.col(f"_w{i}") for i in range(len(on))])
    bits = (named.select(F.floor(place / WORD_BITS).alias("_word"), F.pmod(place, F.lit(WORD_BITS)).alias("_bit"))
            .groupBy("_word").agg(F.bitmap_construct_agg("_bit").alias("_bits")))
    bit = F.pmod(at([F.col(c) for c in on]), F.lit(WORD_BITS))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))
    may = (F.floor(at([F.col(c) for c in on]) / WORD_BITS) == F.col("_word")) & (byte.bitwiseAND(mask) != 0)
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_w{i}")) for i, c in enumerate(on)])
    return df.join(F.broadcast(bits), may, "left_semi").join(named, same, "left_semi")


def spots(df: DataFrame, keys: list[str], first: list[str], last: bool = True) -> DataFrame:
    """``keys..., first..., _rows``: the largest (``last``) or the least rank of each key, and how many rows have it."""
    best = df.groupBy(*keys).agg((F.max if last else F.min)(F.struct(*first)).alias("_best"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.struct(*[F.col(f"a.{c}") for c in first]).eqNullSafe(F.col("b._best"))]
    return df.groupBy(*keys, *first).agg(F.count(F.lit(1)).alias("_rows")).alias("a").join(
        best.alias("b"), functools.reduce(Column.__and__, same), "left_semi")


def rows_at(df: DataFrame, at: DataFrame, keys: list[str], first: list[str], rest: list[str], last: bool = True) -> DataFrame:
    """One row of ``df`` for each of the written ``spots``; only rows that are equal in keys and ``first`` meet as wide rows, and go by ``rest``."""
    spot = [*keys, *first]
    alone = matching(df, at.where("_rows = 1"), spot).select(*df.columns)
    tied = at.where("_rows > 1")
    if tied.isEmpty():
        return alone
    others = [c for c in df.columns if c not in keys]
    one = matching(df, tied, spot).groupBy(*keys).agg(
        (F.max_by if last else F.min_by)(F.struct(*others), F.struct(*first, *rest)).alias("_row"))
    return alone.unionByName(one.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns))


def pick(df: DataFrame, keys: list[str], first: list[str], rest: list[str], last: bool = True) -> DataFrame:
    """One row per ``keys``: the largest (``last``) or the least by the columns ``first``, equal ones by ``rest``."""
    at = stage(spots(df, keys, first, last), "picked", "zstd")
    release(df.sparkSession)
    return rows_at(df, at, keys, first, rest, last)
