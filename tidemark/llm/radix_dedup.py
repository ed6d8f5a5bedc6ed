"""Exact dedup by distributed MSD radix partitioning.

A document's key is its byte length (8 bytes) followed by its normalised
bytes, which makes the key prefix-free.  Level 0 splits all documents by the
length and the first ``first_width`` bytes; every later level splits the groups
that still hold several documents by the next bytes, ``growth`` times as many as
before, so the number of levels is logarithmic in the longest text.  A group
leaves when it is a singleton or when its bytes have ended; what is left together
then is equal byte by byte.  No digest takes part in the decision.

A split is a hash aggregate on (group, next bytes), combined on the map side, so
a group that holds a third of all rows sends one row per task.  The rows learn
their new group by joining the aggregate; a hot key of that join is split by AQE's
skew handling.  Only documents of open groups are read beyond their first bytes.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_ORDER, is_empty, stage, texts

FIRST_WIDTH = 64
GROWTH = 16


def _normaliser(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # bytes.lower() changes A-Z only
            bodies = [t.lower() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2),
                pa.array([hashlib.sha256(t).hexdigest() for t in bodies], pa.string()),
                pa.array([len(t) for t in bodies], pa.int64()),
                pa.array([t[:width] for t in bodies], pa.binary()),
                pa.array([t[width:] for t in bodies], pa.binary()),
            ], names=["doc_id", "rid", "text_sha256", "n_bytes", "head", "tail"])
    return run


def _split(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One radix split: rows equal on ``keys`` share ``gid``, their largest row in the order (doc_id, rid).

    Groups of several rows are written before they are joined back, so the join has an
    exchange of its own on both sides and AQE can split a hot group.
    """
    groups = stage(rows.groupBy(*keys).agg(F.max("ord").alias("gid"), F.max("doc_id").alias("keep_id"),
                                           F.count(F.lit(1)).alias("group_size"))
                   .where("group_size > 1").withColumnsRenamed({k: f"_{k}" for k in keys}), "radix_groups")
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    own = {"gid": "ord", "keep_id": "doc_id", "group_size": F.lit(1).cast("long")}
    return rows.join(groups, on, "left").withColumns({c: F.coalesce(c, v) for c, v in own.items()})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_width: int = FIRST_WIDTH, growth: int = GROWTH, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, rid``.

    Texts are equal when identical after lower-casing A-Z.  The row with the
    largest ``doc_id`` stays; among rows that repeat that id, the last one in scan
    order.  Null text counts as empty (equal to every empty text); a null
    id is smaller than all others.  An empty table gives no rows.  ``rid`` numbers
    the input rows in scan order (or is ``row_col``, if given).
    """
    base = stage(texts(docs, id_col, text_col, row_col).mapInArrow(
        _normaliser(first_width),
        "doc_id long, rid long, text_sha256 string, n_bytes long, head binary, tail binary"), "radix_rows")
    out = ["doc_id", "rid", "text_sha256", "gid", "keep_id", "group_size"]

    split = _split(base.select("doc_id", "rid", "text_sha256", "n_bytes", "head", F.expr(ROW_ORDER).alias("ord")),
                   ["n_bytes", "head"])
    level = stage(split.select(*out, "ord", ((F.col("group_size") > 1) & (F.col("n_bytes") > first_width)).alias("open")),
                  "radix_level")
    done = [level.where(~F.col("open")).select(*out)]
    open_rows = level.where("open").select("rid", "doc_id", "text_sha256", "ord", F.col("gid").alias("group"))
    if not is_empty(open_rows):
        rest = open_rows.join(base.where(F.col("n_bytes") > first_width).select("rid", F.col("tail").alias("rest")), "rid")
        width = first_width
        while True:
            width *= growth
            split = _split(rest.withColumn("digit", F.expr(f"substring(rest, 1, {width})")), ["group", "digit"])
            level = stage(split.select(*out, "ord", F.expr(
                f"CASE WHEN group_size > 1 THEN substring(rest, {width + 1}) ELSE X'' END").alias("rest")), "radix_level")
            still = F.length("rest") > 0
            done.append(level.where(~still).select(*out))
            rest = level.where(still).select("rid", "doc_id", "text_sha256", "ord", F.col("gid").alias("group"), "rest")
            if is_empty(rest):
                break
    rows = reduce(DataFrame.unionAll, done)
    return rows.select("doc_id", "keep_id", "group_size",
                       (F.expr(ROW_ORDER) == F.col("gid")).alias("kept"), "text_sha256", "rid")
