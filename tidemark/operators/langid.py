"""Language identification as a Spark job (ML-7).

Character trigrams are hashed into a fixed number of buckets.  A profile trained from labelled texts holds
``ln(count + 1)`` per bucket and language, and per language the denominator ``ln(total_l + V)`` (add-one
smoothing; V buckets are in use).  A text is scored by

    score(l) = Σ_g ln(c_lg + 1) − N · ln(total_l + V)

over its N trigrams, which equals Σ_g ln P(g | l) with unseen ones at ln 1/(total_l+V).
The best language wins (ties, to 6 digits: alphabetical).  Blank or < 3 character
texts get NULL.  Texts with more than half of their letters in the Sinhala or
Tamil block are decided by the block.

No trigram is shuffled: training counts per Arrow batch before its aggregate by (language, bucket), the profile
(8 bytes a bucket and language) is sent to every task, and a text is scored where it is read.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
NGRAM = 3
MIN_CHARS = 3
LETTERS = r"[\p{L}\p{M}]"
SCRIPT_RULES = [("si", "[඀-෿]"), ("ta", "[஀-௿]")]

# A trigram's bucket: the sum of its code points times these, modulo the largest prime below 2**16.
BUCKETS = 65521
MULTIPLIERS = (25717, 50341, 9103)
SLICE = 1 << 20                # characters hashed at once
BLOCK = 64                     # languages of one scoring function: 34 MB of profile
DIGITS = 1e6


def _stripped(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def _scanned(c) -> Column:
    """The text whose trigrams count: stripped, lower-cased, empty for null."""
    return F.coalesce(F.lower(_stripped(c)), F.lit(""))


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the overlapping trigrams of a text, a slice at a time."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    for s in range(0, len(points) - NGRAM + 1, SLICE):
        part = points[s:s + SLICE + NGRAM - 1].astype(np.int64)
        yield sum(m * part[i:len(part) - NGRAM + 1 + i] for i, m in enumerate(MULTIPLIERS)) % BUCKETS


class Profile:
    """Languages in order, ``ln(count + 1)`` by bucket and language, and the languages' denominators."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        used = int((counts.sum(1) > 0).sum())
        self.weights, self.denominators = np.log(counts + 1.0), np.log(counts.sum(0) + float(used)) if langs else np.zeros(0)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Profile:
    """Profile of the texts with a language; languages x ``BUCKETS`` counts reach the driver, whatever the number of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict = {}
            for one, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for buckets in gram_buckets(t):
                    if one not in counts:
                        counts[one] = np.zeros(BUCKETS, np.int64)
                    counts[one] += np.bincount(buckets, minlength=BUCKETS)
            for one, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                                 names=["lang", "bucket", "n"])
    got = (labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), _scanned(text).alias("t"))
           .mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = got.column("lang").to_pylist()
    langs = sorted(set(names))
    place = {one: i for i, one in enumerate(langs)}
    counts = np.zeros((BUCKETS, len(langs)), np.int64)
    counts[got.column("bucket").to_numpy(), np.array([place[x] for x in names], np.int64)] = got.column("n").to_numpy()
    return Profile(langs, counts)


def _best(spark: SparkSession, p: Profile, lo: int, hi: int) -> Column:
    """A function from scanned texts to (least negated score, its language) among the languages ``lo`` to ``hi``."""
    shared = spark.sparkContext.broadcast((p.langs[lo:hi], p.weights[:, lo:hi].copy(), p.denominators[lo:hi]))

    @F.pandas_udf("neg double, lang string")
    def best(texts: pd.Series) -> pd.DataFrame:
        langs, weights, denominators = shared.value
        out = []
        for t in texts:
            total, n = np.zeros(len(langs)), 0
            for buckets in gram_buckets(t):
                seen, times = np.unique(buckets, return_counts=True)
                total, n = total + times @ weights[seen], n + len(buckets)
            neg = np.floor((n * denominators - total) * DIGITS + 0.5)
            i = int(neg.argmin())
            out.append((float(neg[i]), langs[i]))
        return pd.DataFrame(out, columns=["neg", "lang"])
    return best


def language(spark: SparkSession, profile: Profile, text: str | Column) -> Column:
    """The language of a text column, as a column; NULL for blank and very short texts, and all of them where nothing was labelled."""
    c = F.col(text) if isinstance(text, str) else text
    rule = F.lit(None).cast("string")
    for code, pat in reversed(SCRIPT_RULES):
        rule = F.when(F.regexp_count(c, F.lit(pat)) * 2 > F.regexp_count(c, F.lit(LETTERS)), F.lit(code)).otherwise(rule)
    blocks = [_best(spark, profile, lo, lo + BLOCK)(_scanned(c)) for lo in range(0, len(profile.langs), BLOCK)]
    best = functools.reduce(F.least, blocks)["lang"] if blocks else F.lit(None).cast("string")
    return F.when(c.isNull() | (F.length(_stripped(c)) < MIN_CHARS), F.lit(None).cast("string")).otherwise(F.coalesce(rule, best))


def fit_detect(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the labelled rows and label every row: ``key, lang_pred``."""
    return docs.select(key, language(docs.sparkSession, train(docs, text, lang), text).alias("lang_pred"))
