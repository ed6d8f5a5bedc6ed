"""Exact quantiles without a single-task sort of the whole column.

``percentile`` (exact) keeps every distinct value of the group in one
aggregation buffer; for a global quantile that is the whole column in one
task.  Instead the wanted order statistics are closed in on:

1. ``percentile_approx`` gives two values around the wanted rank (rank error at most m / accuracy);
2. one pass counts the values below, at and between them; a rank that falls on one of the two is settled;
3. the open interval between them is the next, much smaller column, until at most ``SLICE`` values
   are left.  Only these are collected: a fixed number, whatever the column's length.

If the two values ever miss the rank the margin is widened and the pass
repeats.  Results are plain floats, so downstream plans see literals.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most values that are ever collected.
SLICE = 10_000


def _lerp(a: float, b: float, t: float) -> float:
    # NumPy's linear interpolation (stable form used by numpy.quantile)
    diff = b - a
    return b - diff * (1.0 - t) if t >= 0.5 else a + diff * t


def order_statistics(df: DataFrame, c: str, n: int, ranks: list[int], accuracy: int = 10_000,
                     most: int = SLICE) -> dict[int, float]:
    """Values at 0-based ``ranks`` (neighbours) of the ``n`` non-null values of a column."""
    x, out, todo = F.col(c).cast("double"), {}, sorted(set(ranks))
    inside, below, m, margin = df.where(F.col(c).isNotNull()).select(x.alias("x")), 0, n, 4.0 / accuracy
    while todo:
        if m <= most:
            values = sorted(r.x for r in inside.collect())
            return out | {r: values[r - below] for r in todo}
        at = [(r - below) / max(1, m - 1) for r in todo]
        lo, hi = inside.agg(F.percentile_approx("x", [max(0.0, at[0] - margin), min(1.0, at[-1] + margin)], accuracy)).first()[0]
        got = inside.agg(F.count_if(F.col("x") < lo).alias("less"), F.count_if(F.col("x") == lo).alias("low"),
                         F.count_if((F.col("x") > lo) & (F.col("x") < hi)).alias("between"),
                         F.count_if(F.col("x") == hi).alias("high")).first()
        first = below + got.less + got.low           # rank of the first value between
        last = first + got.between
        if todo[0] < below + got.less or todo[-1] >= last + (got.high if hi > lo else 0):
            margin *= 8.0
            continue
        for r in list(todo):
            if r < first:
                out[r] = float(lo)
            elif r >= last:
                out[r] = float(hi)
            else:
                continue
            todo.remove(r)
        inside, below, m = inside.where((F.col("x") > lo) & (F.col("x") < hi)), first, got.between
    return out


def exact_quantiles(df: DataFrame, cols: list[str], q: float, accuracy: int = 10_000,
                    most: int = SLICE) -> dict[str, float | None]:
    """Exact linear-interpolated ``q`` quantile of each column (NULLs ignored)."""
    if not cols:
        return {}
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    out: dict[str, float | None] = {}
    for c in cols:
        n = counts[c]
        if not n:
            out[c] = None
            continue
        pos = q * (n - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        got = order_statistics(df, c, n, [lo, hi], accuracy, most)
        out[c] = _lerp(got[lo], got[hi], pos - lo)
    return out
