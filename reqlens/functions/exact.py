"""Exact two-decimal arithmetic on integers.

Rounding a double to two places is not reproducible: the double sum behind an
average depends on partitioning, and halfway cases such as 1.005 land either
side depending on the engine.  Everything public is still a ``double``, but
each value is computed as an integer number of hundredths first, rounded
HALF_UP (away from zero) with integer division, and divided by 100 once at
the end.  The same integers come out under any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", _col(a), _col(b) if not isinstance(b, int) else F.lit(b))


def half_up_div(num, den) -> Column:
    """``round(num / den)`` HALF_UP for integer ``num`` and ``den > 0``; NULL if ``den`` is 0 or NULL."""
    num, den = _col(num).cast("long"), _col(den).cast("long")
    magnitude = idiv(F.abs(num) * 2 + den, den * 2)
    return F.when(den > 0, F.when(num < 0, -magnitude).otherwise(magnitude))


def hours_hundredths(seconds) -> Column:
    """Whole seconds -> hours in hundredths, HALF_UP (36 s per hundredth)."""
    return half_up_div(seconds, F.lit(36))


def to_hundredths(value) -> Column:
    """A double that holds k/100 back to the integer k."""
    return F.round(_col(value) * 100).cast("long")


def from_hundredths(k) -> Column:
    return _col(k).cast("double") / 100


def mean_hundredths(sum_hundredths, n) -> Column:
    """Mean of hundredths, itself in hundredths: ``round(S / n)``."""
    return half_up_div(sum_hundredths, n)


def ratio_2dp(num, den) -> Column:
    """``round(num / den, 2)`` as a double, from integers."""
    return from_hundredths(half_up_div(_col(num).cast("long") * 100, den))


def share_pct(part, whole) -> Column:
    """``round(part * 100 / whole, 2)`` as a double, from integers."""
    return from_hundredths(half_up_div(_col(part).cast("long") * 10000, whole))


def signed_pct_change(count, avg_hundredths) -> Column:
    """``round((count - A/100) / (A/100) * 100, 2)`` with ``A`` in hundredths; NULL if ``A`` is 0."""
    a = _col(avg_hundredths).cast("long")
    x = (_col(count).cast("long") * 100 - a) * 10000
    return from_hundredths(half_up_div(x, F.nullif(a, F.lit(0))))
