"""Numeric helpers that keep results identical to the reference database.

* Ratios are computed on doubles: decimal / decimal is a double there, while
  Spark would keep a decimal(38,10).
* Rounding of doubles scales, rounds half away from zero, then unscales
  (`round(x * 10^d) / 10^d`), which is how the reference rounds; Spark's
  `round(x, d)` rounds the shortest decimal string of x instead.
* Money stays decimal; sums are widened to decimal(38,2) like the reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)
RATE = DecimalType(12, 6)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dbl(x) -> Column:
    return _c(x).cast("double")


def round_to(x, digits: int) -> Column:
    """Scaled half-away-from-zero rounding of a double."""
    scale = float(10 ** digits)
    s = dbl(x) * F.lit(scale)
    r = F.round(s, 0)
    # keep the sign of a negative value that rounds to zero (-0.0), as C rounding does
    r = F.when((r == 0) & (s < 0), F.lit(-0.0)).otherwise(r)
    return r / F.lit(scale)


def round2(x) -> Column:
    return round_to(x, 2)


def pct_change(cur, prev, absolute_base: bool = True) -> Column:
    """(cur - prev) / |prev| * 100 rounded to 2; null when prev is null or 0."""
    cur, prev = _c(cur), _c(prev)
    base = F.abs(prev) if absolute_base else prev
    return F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double")).otherwise(
        round2(dbl(cur - prev) / dbl(base) * F.lit(100.0)))


def ratio_pct(num, den) -> Column:
    """num / den * 100 rounded to 2; null when den is 0 (null den gives null)."""
    num, den = _c(num), _c(den)
    return F.when(den == 0, F.lit(None).cast("double")).otherwise(
        round2(dbl(num) / dbl(den) * F.lit(100.0)))


def safe_div(num, den) -> Column:
    """Double division that yields null for a zero or null denominator."""
    num, den = _c(num), _c(den)
    return F.when(den.isNull() | (den == 0), F.lit(None).cast("double")).otherwise(dbl(num) / dbl(den))


def crore(x) -> Column:
    """Amount in crore (1e7), rounded to 2 decimals."""
    return round2(dbl(x) / F.lit(10000000.0))
