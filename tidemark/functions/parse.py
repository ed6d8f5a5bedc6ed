"""Lenient parsing of bronze fields: ids, durations, timestamps, numbers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 duration grammar accepted by the pipeline,
# P[nD][T[nH][nM][nS]] with non-negative integers, anchored at both ends.
ISO_DURATION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def video_id(c) -> Column:
    """Polymorphic id: a plain string, or a JSON object carrying ``videoId``.

    An object without ``videoId`` (or a NULL) gives NULL.
    """
    c = _c(c)
    return F.when(F.ltrim(c).startswith("{"), F.get_json_object(c, "$.videoId")).otherwise(c)


def iso_duration_seconds(c) -> Column:
    """``P1DT2H3M4S`` → 93784; ``P``/``PT`` → 0; anything else, or a number beyond 64 bits → NULL."""
    c = _c(c)
    total = F.lit(0).cast("bigint")
    for i, seconds in enumerate((86400, 3600, 60, 1), 1):
        part = F.nullif(F.regexp_extract(c, ISO_DURATION, i), F.lit(""))
        value = F.when(part.isNull(), F.lit(0).cast("bigint")).otherwise(part.try_cast("bigint"))
        total = F.try_add(total, F.try_multiply(value, F.lit(seconds).cast("bigint")))
    return F.when(c.rlike(ISO_DURATION), total).cast("bigint")


def lenient_timestamp(c) -> Column:
    """ISO-8601 text (``Z``, offsets, fractions) → UTC TIMESTAMP; bad → NULL."""
    return F.try_to_timestamp(_c(c))


def lenient_double(c) -> Column:
    """Text or number → DOUBLE; unparsable → NULL."""
    return _c(c).cast("string").try_cast("double")


def pick_title(title, localized_title) -> Column:
    """Title, else the localized title; an empty title counts as missing."""
    return F.coalesce(F.nullif(_c(title), F.lit("")), _c(localized_title))
