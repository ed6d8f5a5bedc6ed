"""Embedding whitening: blockwise QR, bidiagonalisation, dqds and twisted factorisations.

The vectors are made integers, ``x = floor(256 * c)``; the fit list holds each distinct one once.

1. Every task reduces its centred rows block by block to a triangular factor, factors are stacked and reduced again
   in groups, until one R is left: the covariance is RᵀR / n and is never formed, so no digits are lost to squaring.
2. Householder reflections bring R to bidiagonal form, R = U B Vᵀ.
3. dqds finds the squares of B's singular values by quotient-difference sweeps, with shifts that are
   lower bounds by construction (1 over the trace of the inverse), so every quotient stays positive.
4. For each one, the factorisations of BᵀB - λ from the top and from the bottom meet at the row where the twist's pivot is least,
   and the vector is read off from there; V carries it back.

Only R (as many rows as a vector has entries), the sums and the directions reach the driver, whatever the number of vectors.
"""
from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

SCALE = 256
BLOCK = 4096                                   # rows between two reductions
FACTORS = 64 << 20                             # bytes of triangular factors that one task stacks
EPS = np.finfo(np.float64).eps
TINY = 1e-280


# --- the solver -------------------------------------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """``v, beta`` with ``(1 - beta v vᵀ) x`` zero but for its first entry."""
    v, size = x.astype(np.float64), np.linalg.norm(x)
    if size == 0:
        return v, 0.0
    v = v / size
    v[0] += np.copysign(1.0, v[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and ``v`` (orthogonal) with ``r = u b vᵀ``."""
    a, n = np.array(r, np.float64), r.shape[1]
    v = np.eye(n)
    for k in range(n):
        w, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w, beta = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= beta * np.outer(v[:, k + 1:] @ w, w)
    return a.diagonal().copy(), a.diagonal(1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step: new quotients, new off-quotients, and the differences on the way."""
    d, qs, es, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        ds.append(d)
        s = max(d + e[k], TINY)
        ratio = q[k + 1] / s
        qs.append(s)
        es.append(e[k] * ratio)
        d = d * ratio - shift
    ds.append(d)
    qs.append(d)
    return qs, es, ds


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix with squared entries ``q`` and ``e``, falling."""
    size = max(float(q.max(initial=0)), float(e.max(initial=0)))
    if size == 0:
        return np.zeros(len(q))
    out: list[float] = []
    blocks = [([max(x, TINY) for x in (q / size).tolist()], (e / size).tolist(), 0.0)]
    while blocks:
        q_, e_, moved = blocks.pop()
        for _ in range(1000 * len(q_)):
            if len(q_) == 1:
                break
            cut = next((k for k in range(len(e_) - 1, -1, -1) if e_[k] <= EPS * EPS * (q_[k + 1] + moved)
                        or e_[k] <= EPS * EPS * (q_[k] + moved)), None)
            if cut is not None:
                blocks.append((q_[:cut + 1], e_[:cut], moved))
                q_, e_ = q_[cut + 1:], e_[cut + 1:]
                continue
            if 1.5 * q_[0] < q_[-1]:           # large quotients belong to the top
                q_, e_ = q_[::-1], e_[::-1]
            q_, e_, ds = _sweep(q_, e_, 0.0)
            q_ = [max(x, TINY) for x in q_]
            _, _, ds = _sweep(q_, e_, 0.0)
            shift = 1.0 / sum(1.0 / max(x, TINY) for x in ds)
            shift *= 1 - 4 * len(q_) * EPS
            if shift > EPS * (moved + q_[-1]) * 1e-3:
                new = _sweep(q_, e_, shift)
                if min(new[2]) >= 0:
                    q_, e_ = [max(x, TINY) for x in new[0]], new[1]
                    moved += shift
        out.extend(x + moved for x in q_)
    return np.sort(np.array(out))[::-1] * size


def twisted(a: np.ndarray, b: np.ndarray, value: float, skip: int = 0) -> np.ndarray:
    """Eigenvector of BᵀB (B bidiagonal, ``a`` and ``b``) for ``value``; ``skip`` takes the next best twist."""
    n = len(a)
    floor = EPS * max(value, TINY)

    def pivot(x: float) -> float:
        return x if abs(x) > floor * EPS else np.copysign(floor * EPS + TINY, x)
    s, p, down, up = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n):
        down[i] = pivot(a[i] * a[i] + s[i])
        if i < n - 1:
            s[i + 1] = b[i] * b[i] * s[i] / down[i] - value
    p[n - 1] = a[n - 1] * a[n - 1] - value
    for i in range(n - 1, 0, -1):
        up[i] = pivot(b[i - 1] * b[i - 1] + p[i])
        p[i - 1] = a[i - 1] * a[i - 1] * p[i] / up[i] - value
    r = int(np.argsort(np.abs(s + p + value), kind="stable")[min(skip, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -a[i] * b[i] / down[i] * z[i + 1]
        if abs(z[i]) > 1e150:
            z /= abs(z[i])
    for i in range(r, n - 1):
        z[i + 1] = -a[i] * b[i] / up[i + 1] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``rᵀr`` (fewer, where its rank is less), falling, and their unit vectors as columns."""
    n = r.shape[1]
    a, b, v = bidiagonal(r)
    size = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    found: list[tuple[float, int, int]] = []
    lo = 0
    for i in range(n):                         # blocks that do not touch are solved apart
        if i == n - 1 or abs(b[i]) <= EPS * size:
            found += [(float(x), lo, i + 1) for x in dqds(a[lo:i + 1] ** 2, b[lo:i] ** 2)]
            lo = i + 1
    found.sort(key=lambda x: (-x[0], x[1]))
    rank = sum(x[0] > (n * EPS) ** 2 * found[0][0] for x in found) if found else 0
    values, vectors = [], np.zeros((n, 0))
    for value, lo, hi in found[:min(k, rank)]:
        for skip in range(hi - lo):            # only close values need another twist than the first
            z = np.zeros(n)
            z[lo:hi] = twisted(a[lo:hi], b[lo:hi - 1], value, skip)
            for _ in range(2):
                z -= vectors @ (vectors.T @ z)
            if np.linalg.norm(z) > 0.1:
                break
        else:                                  # a vector of a multiple value: any one orthogonal to the others
            rest = np.eye(n) - vectors @ vectors.T
            rest[:lo], rest[hi:] = 0, 0
            z = rest[:, np.argmax(np.linalg.norm(rest, axis=0))]
        values.append(value)
        vectors = np.column_stack([vectors, z / np.linalg.norm(z)])
    out = v @ vectors
    if out.size:                               # a sign that does not depend on the way
        out *= np.sign(out[np.abs(out).argmax(0), np.arange(out.shape[1])])
    return np.array(values), out


# --- Spark ------------------------------------------------------------------------------------------

def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id long, x array<long>`` of the vectors that are not null and hold only finite entries."""
    least = float(1 << 63) / SCALE
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < least)))
            .select("vec_id", F.transform("v", lambda c: F.floor(c * float(SCALE)).cast("long")).alias("x")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    flat, sizes = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, most = 0, [0] * width, 0
        for b in batches:
            x = _matrix(b.column(0), width)
            if len(x):
                high, low = (x >> 32).sum(0).tolist(), (x & 0xFFFFFFFF).sum(0).tolist()
                total = [t + (h << 32) + lo for t, h, lo in zip(total, high, low)]
                n, most = n + len(x), max(most, -int(x.min()), int(x.max()))
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *range(width)], pa.int32()), pa.array([Decimal(v) for v in (most, n, *total)], pa.decimal128(38, 0))],
                                         names=["dim", "s"])
    return run


def _triangle(stack: list[np.ndarray], width: int) -> np.ndarray:
    rows = np.concatenate([np.zeros((0, width)), *stack])
    return np.linalg.qr(rows, mode="r") if len(rows) > width else rows


def _reduced(width: int, mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, held, size = np.zeros((0, width)), [], 0
        for b in batches:
            held.append(_matrix(b.column(0), width) - mean)
            size += b.num_rows
            if size >= BLOCK:
                r, held, size = _triangle([r, *held], width), [], 0
        r = _triangle([r, *held], width)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["place", "r"])
    return run


def _factor(factors: DataFrame, width: int) -> np.ndarray:
    """The one triangular factor left after stacking ``factors`` group by group."""
    fan = max(2, min(64, FACTORS // max(1, 8 * width * width)))

    def joined(key: tuple, t: pa.Table) -> pa.Table:
        stack = [np.frombuffer(x, np.float64).reshape(-1, width) for x in t.sort_by("place").column("r").to_pylist()]
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([_triangle(stack, width).tobytes()], pa.binary())], names=["place", "r"])
    while (factors.agg(F.max("place")).first()[0] or 0) > 0:
        factors = stage(factors.groupBy(F.expr(f"place div {fan}").alias("up")).applyInArrow(joined, "place long, r binary"), "factors")
    rows = factors.collect()                   # one row
    return np.frombuffer(rows[0]["r"], np.float64).reshape(-1, width) if rows else np.zeros((0, width))


class Whitening:
    """A fit: ``n`` and ``sums`` of the fit list (exact), eigenvalues ``values``, unit vectors ``vectors`` (columns), ``trace`` of the
    covariance, and ``error``, the largest deviation of the whitened covariance from the identity."""

    def __init__(self, n: int, sums: list[int], most: int, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.most, self.values, self.vectors, self.trace, self.error = n, sums, most, values, vectors, trace, 0.0
        self.mean = np.array([float(Fraction(s, n)) for s in sums])
        self.turn = vectors / np.sqrt(values)[None, :] if len(values) else vectors

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of ``n * x - sums``, exact; None beyond a long.  Integers are as wide as the fit's bounds need."""
        wide = len(self.sums) * (self.n * self.most + max(map(abs, self.sums), default=0)) ** 2 >= 1 << 63
        kind = object if wide else np.int64
        d = x.astype(kind) * self.n - np.array(self.sums, kind)
        out = (d * d).sum(1).tolist() if d.size else [0] * len(x)
        return [v if v < 1 << 63 else None for v in out] if wide else out


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """The whitening of ``integers`` rows, fitted on every distinct vector; None without rows or entries.

    Vectors may differ in length: shorter ones count as filled with zeros.
    """
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    full = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    distinct = stage(rows.select(full.alias("x")).distinct(), "fit")
    got = {r["dim"]: int(r["s"]) for r in distinct.mapInArrow(_sums(width), "dim int, s decimal(38,0)").groupBy("dim").agg(
        F.when(F.col("dim") == -2, F.max("s")).otherwise(F.sum("s")).alias("s")).collect()}        # one row an entry
    n, most, sums = got[-1], got[-2], [got[i] for i in range(width)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    r = _factor(stage(distinct.mapInArrow(_reduced(width, mean), "place long, r binary"), "factors"), width)
    square = np.zeros((width, width))
    square[:min(len(r), width)] = r[:width]
    squares, vectors = directions(square, components)
    out = Whitening(n, sums, most, squares / n, vectors, float((square ** 2).sum()) / n)
    out.error = _identity_error(distinct, out)
    return out


def _identity_error(distinct: DataFrame, w: Whitening) -> float:
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))       # sums in the last row and column
        for b in batches:
            y = w.whitened(_matrix(b.column(0), len(w.sums)))
            y = np.column_stack([y, np.ones(len(y))])
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "v"])
    if not k:
        return 0.0
    total = np.zeros((k + 1) ** 2)
    for r in distinct.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k + 1) / w.n
    return float(np.abs(total[:k, :k] - np.outer(total[:k, k], total[:k, k]) - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or hold a null or non-finite entry (or one whose integer exceeds a long) take no part.  Repeated
    vectors count once in the fit and get their rows each; null and repeated ids stay.  Components are numbered by falling eigenvalue
    and end at the rank: fewer entries than ``components``, one distinct vector or vectors of no entry give
    fewer rows, or none.  Equal eigenvalues leave the choice of their components open.  ``deviation`` is null where it
    exceeds a long.  An empty table gives no rows; other columns of the input are not read, whatever their names.
    """
    rows = integers(vectors, id_col, vector_col)
    w = fit(rows, components)
    if w is None or not len(w.values):
        return vectors.sparkSession.createDataFrame([], _OUT)
    width, k = len(w.sums), len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _OUT.split(", ")]
        for b in batches:
            x = _matrix(b.column(1), width)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            deviation = pa.array(w.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            size = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, w.n)), deviation,
                 pa.array(w.whitened(x).ravel()), pa.array(np.tile(w.values / w.trace, len(x))), pa.array(np.full(size, w.error))], names=names)
    return rows.mapInArrow(run, _OUT)
