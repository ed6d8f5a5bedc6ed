"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are the trigrams of its bytes' classes (letters of either case,
digits, white space, bytes beyond ASCII; each punctuation mark is its own class), hashed to ``BUCKETS``,
and two counts of words that do and do not repeat the word before.  Terms weigh
square root of frequency × inverse document frequency; the leading eigenvectors of the labelled
rows' term matrix give the latent space.

The model is fitted on a bounded sample of labelled rows (``per_label`` of each
label, the smallest by a hash of the id) and broadcast: its size is fixed by
parameters.  Every document's exact cosine with every labelled vector is one
block product per Arrow batch; its ``neighbours`` nearest vote with their label,
weighted by ``similarity ** sharpness``.  Only the text enters a score.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

BUCKETS = 2048
TERMS = BUCKETS + 2
DIMENSIONS = 32
NEIGHBOURS = 15
SHARPNESS = 8
PER_LABEL = 2048
THRESHOLD = 0.7
_SLICE = 1 << 20


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint32)
    for b in range(256):
        c = chr(b)
        kind[b] = (1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if "0" <= c <= "9" else 4 if c == " "
                   else 5 if c == "\n" else 6 if b >= 128 else 7 + b % 64 if 33 <= b < 127 else 0)
    return kind


_KIND = _classes()


def term_counts(text: bytes) -> np.ndarray:
    """Counts of the ``TERMS`` terms of one text; memory is bounded by a slice, not by the text."""
    out = np.zeros(TERMS, np.float64)
    last = None
    for at in range(0, len(text), _SLICE):
        kinds = _KIND[np.frombuffer(text, np.uint8, min(_SLICE + 2, len(text) - at), at)]
        if len(kinds) >= 3:
            code = (kinds[:-2] * np.uint32(71) + kinds[1:-1]) * np.uint32(71) + kinds[2:]
            out[:BUCKETS] += np.bincount((code * np.uint32(2654435761)) >> np.uint32(21), minlength=BUCKETS)
    words = text.split()
    if words:
        same = sum(map(bytes.__eq__, words, words[1:]))
        out[BUCKETS:] = same, len(words) - same
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray         # terms × dimensions
    vectors: np.ndarray      # labelled rows × dimensions, unit length
    labels: np.ndarray       # 0 or 1


def embed(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    counts = np.array([term_counts(t) for t in texts]).reshape(len(texts), TERMS)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return _unit(np.sqrt(share) * idf).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_label: int = PER_LABEL, dimensions: int = DIMENSIONS) -> Model | None:
    """The model, learned from labelled rows whose ``crc32(id as text) mod 4`` is not 2; None without such rows.

    Rows with a null id, or a label other than 0 and 1, teach nothing.  Of each label the ``per_label`` rows
    with the smallest hash of the id are used (fewer if there are fewer), so the sample does not depend on partitioning.
    Other columns of both tables, whatever their names, are not read.
    """
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & (F.crc32(F.col("id").cast("string")) % 4 != 2))
    order = [F.xxhash64("id"), F.col("id")]
    sample = None
    for k in (0, 1):
        part = rows.where(F.col("label") == k).distinct().orderBy(*order).limit(per_label)
        sample = part if sample is None else sample.unionAll(part)
    # At most 2 × per_label rows: the broadcast has a fixed bound, and so has what is collected, even
    # where the documents repeat an id.
    found = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
             .join(F.broadcast(sample), "id"))
    counts = F.pandas_udf(lambda s: pd.Series([term_counts(bytes(t)).astype("<f4").tobytes() for t in s]), "binary")
    sample = found.select("id", "label", counts("text").alias("counts")).orderBy(*order, "label", "counts").limit(2 * per_label)
    got = sample.select("label", "counts").mapInArrow(_learned(dimensions), "idf binary, axes binary, vectors binary, labels binary").toArrow()
    if not got.num_rows:
        return None
    idf, axes, vectors, y = (np.frombuffer(got.column(c)[0].as_buffer(), t) for c, t in (
        ("idf", np.float64), ("axes", np.float32), ("vectors", np.float32), ("labels", np.float64)))
    return Model(idf, axes.reshape(TERMS, -1), vectors.reshape(len(y), -1), y)


def _learned(dimensions: int):
    """The model of the sampled rows, which are one partition of bounded size, computed where they are: the driver gets the result only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, rows = [], []
        for b in batches:
            labels += b.column(0).to_pylist()
            rows += [np.frombuffer(c.as_buffer(), "<f4") for c in b.column(1)]
        if not rows:
            return
        y, x = np.array(labels, np.float64), np.stack(rows)              # one single-precision copy, turned into weights in place
        rows.clear()
        idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
        x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
        np.sqrt(x, out=x)
        x *= idf.astype(np.float32)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
        axes = np.ascontiguousarray(axes[:, ::-1][:, :dimensions], np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (idf, axes, _unit(x @ axes), y)],
                                         names=["idf", "axes", "vectors", "labels"])
    return run


def vote(model: Model, texts: list[bytes], neighbours: int = NEIGHBOURS, sharpness: int = SHARPNESS) -> np.ndarray:
    """Score of each text: share of label 1 among its nearest labelled vectors, weighted by similarity."""
    if not texts:
        return np.zeros(0)
    sims = _unit(embed(texts, model.idf) @ model.axes) @ model.vectors.T
    k = min(neighbours, sims.shape[1])
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(sims, near, axis=1).astype(np.float64), 0) ** sharpness
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight * model.labels[near]).sum(axis=1) / np.maximum(total, 1e-300), 0.0)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", neighbours: int = NEIGHBOURS,
          sharpness: int = SHARPNESS) -> Column:
    """Score column (0 to 1) over ``docs``: no shuffle, all other columns can stay.

    A null or empty text has no term, hence no similarity to anything, and scores
    0.  Without a model (no labelled rows) nothing speaks against a text: 1.
    """
    if model is None:
        return F.lit(1.0)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batch: pd.Series) -> pd.Series:
        m, texts, out = Model(*shared.value), [bytes(t) for t in batch], []
        for at in range(0, len(texts), 256):
            out.append(vote(m, texts[at:at + 256], neighbours, sharpness))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))
    return F.pandas_udf(run, DoubleType())(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
