"""Numeric rules: age floor, winsorising, decay, z-score and rising score."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour).
AGE_FLOOR_MIN = 0.0001      # minutes
DECAY_TAU_MIN = 120.0       # minutes
CAP_QUANTILE = 0.999
RISING_Z = 2.0
SCORE_Z_MAX = 5.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_age(c) -> Column:
    return F.greatest(_c(c), F.lit(AGE_FLOOR_MIN))


def winsorise(c, hi) -> Column:
    """Clip to [0, hi] only when the cap is known and positive."""
    x, h = _c(c), _c(hi)
    return F.when(h.isNotNull() & (h > 0), F.least(F.greatest(x, F.lit(0.0)), h)).otherwise(x)


def decay(rate, age_min, tau: float = DECAY_TAU_MIN) -> Column:
    return _c(rate) * F.exp(-_c(age_min) / F.lit(tau))


def rising_flag(z) -> Column:
    return (_c(z) >= RISING_Z).cast("int")


def rising_score(z) -> Column:
    """round(clip(z, 0, 5) / 5 * 100, 1), half to even like NumPy."""
    clipped = F.least(F.greatest(_c(z), F.lit(0.0)), F.lit(SCORE_Z_MAX))
    return F.rint(clipped / F.lit(SCORE_Z_MAX) * F.lit(100.0) * F.lit(10.0)) / F.lit(10.0)
