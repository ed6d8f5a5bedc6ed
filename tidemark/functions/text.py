"""Text functions: whitespace cleanup, Unicode words, n-grams, label rules."""
from __future__ import annotations

import functools
import itertools
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's behaviour):
#   word        = a run of Unicode letters, marks or numbers
#   whitespace  = Unicode White_Space plus the separators U+001C..U+001F
#                 (the set Python's str methods treat as space)
#   short part  = a label part of at most 1 character
#   short share = more than 0.4 of the parts short → label is unreadable
#   URL rule    = platform youtube and an 11-character id
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+"
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
SHORT_PART_MAX_LEN = 1
SHORT_SHARE_LIMIT = 0.4
WATCH_URL_PREFIX = "https://www.youtube.com/watch?v="
WATCH_ID_LEN = 11


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c) -> Column:
    """NULL → ''; whitespace runs → one space; ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), WHITESPACE_RUN, " "))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Unicode NFC normalisation (no JVM built-in exists in Spark 4.1)."""
    return s if s.isna().all() else s.str.normalize("NFC")


@functools.lru_cache(maxsize=1)
def unstable_class() -> str:
    """A regex class of the characters that NFC may change or move: a text without any is in NFC (the standard's quick check).

    These are the characters that NFC replaces, those that it may join to the one before them, and those with a
    combining class.  Derived from the Unicode tables of this Python; the first one is U+0300.
    """
    joins = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}           # Hangul vowels and finals
    bad = []
    for c in (*range(0xD800), *range(0xE000, sys.maxunicode + 1)):
        parts = unicodedata.decomposition(chr(c))
        if parts and not parts.startswith("<"):
            if not unicodedata.is_normalized("NFC", chr(c)):
                bad.append(c)
            elif " " in parts:
                joins.add(int(parts.split()[1], 16))
        elif unicodedata.combining(chr(c)):
            bad.append(c)
    points = sorted({*bad, *joins})
    runs = [(a[0], a[-1]) for a in (list(g) for _, g in itertools.groupby(enumerate(points), lambda p: p[1] - p[0]))]
    return "[" + "".join(f"\\x{{{lo[1]:X}}}-\\x{{{hi[1]:X}}}" for lo, hi in runs) + "]"


def maybe_not_nfc(c) -> Column:
    """Whether a text holds a character that NFC may change; Latin texts are told by one small class."""
    c = _c(c)
    return F.coalesce(c.rlike(r"[^\x{0}-\x{2FF}]") & c.rlike(unstable_class()), F.lit(False))


def with_nfc(df: DataFrame, c: str) -> DataFrame:
    """``df`` with column ``c`` in NFC: only texts that may need it go through Python, the others as null; ``df`` is read once."""
    return df.withColumn("_odd", F.when(maybe_not_nfc(c), F.col(c))).withColumn(c, F.coalesce(nfc("_odd"), F.col(c))).drop("_odd")


def words(c) -> Column:
    """Words of a text (NULL → empty array)."""
    c = _c(c)
    return F.coalesce(F.regexp_extract_all(c, F.lit(WORD_PATTERN), 0), F.array().cast("array<string>"))


def tokens(c, min_len: int = 2) -> Column:
    """Lower-cased words of at least ``min_len`` characters (TF-IDF tokens)."""
    return F.filter(words(F.lower(_c(c))), lambda w: F.length(w) >= min_len)


def bigrams(arr) -> Column:
    """Adjacent pairs of an array, joined by one space; never across rows.

    ``zip_with`` of the array with itself shifted by one: a single pass,
    the array expression is read twice, not once per element.
    """
    a = _c(arr)
    n = F.size(a) - 1
    return F.when(
        F.size(a) >= 2,
        F.zip_with(F.slice(a, 1, n), F.slice(a, 2, n), lambda x, y: F.concat(x, F.lit(" "), y)),
    ).otherwise(F.array().cast("array<string>"))


def readable_label(label, sample_title) -> Column:
    """Fall back to the sample title when a label is empty or mostly 1-char parts."""
    lbl = F.coalesce(_c(label), F.lit(""))
    samp = F.coalesce(_c(sample_title), F.lit(""))
    parts = F.filter(F.split(F.trim(F.regexp_replace(lbl, WHITESPACE_RUN, " ")), " "), lambda p: p != "")
    n = F.size(parts)
    short = F.size(F.filter(parts, lambda p: F.length(p) <= SHORT_PART_MAX_LEN))
    fallback = F.when(samp != "", samp).otherwise(lbl)
    return F.when((n == 0) | (short / n > SHORT_SHARE_LIMIT), fallback).otherwise(lbl)


def display_label(topic_label, sample_title, width: int = 80) -> Column:
    """Blank label → sample title; cut to ``width`` characters."""
    return F.substring(F.coalesce(F.nullif(_c(topic_label), F.lit("")), _c(sample_title)), 1, width)


def watch_url(platform, video_id) -> Column:
    vid = _c(video_id)
    ok = (F.lower(F.coalesce(_c(platform), F.lit("youtube"))) == "youtube") & (F.length(vid) == WATCH_ID_LEN)
    return F.when(ok, F.concat(F.lit(WATCH_URL_PREFIX), vid))


def title_search(title, query: str, literal: bool = False) -> Column:
    """Case-insensitive match; a regex by default; NULL title → false."""
    t = F.lower(_c(title))
    q = query.lower()
    hit = t.contains(q) if literal else t.rlike(q)
    return F.coalesce(hit, F.lit(False))
