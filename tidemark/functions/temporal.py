"""Time helpers: hour buckets, minute differences, local-time display."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: display timezone of the dashboard.
LOCAL_TZ = "Asia/Colombo"
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(c) -> Column:
    return F.date_trunc("hour", _c(c))


def minutes_between(later, earlier) -> Column:
    """Fractional minutes between two TIMESTAMPs (microsecond precision)."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(60_000_000.0)


def to_local(c, tz: str = LOCAL_TZ) -> Column:
    return F.from_utc_timestamp(_c(c), tz)


def iso_z(c) -> Column:
    return F.date_format(_c(c), ISO_Z_FORMAT)
