"""Aggregates whose result does not depend on the order in which partial sums meet.

Doubles are scaled to whole numbers, summed as longs, and scaled back once at the end, so a
retried or re-planned stage yields the same bits. Long sums also stay in the codegen'd hash
aggregate, where wide decimals would not. A sum of cents holds up to 9.2e16 currency units; beyond
that ANSI mode stops the query instead of wrapping around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CENT = 100
_RATE = 1_000_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scaled(c: Column | str, scale: int) -> Column:
    return F.rint(_col(c) * F.lit(float(scale))).cast("long")


def cents(c: Column | str) -> Column:
    return _scaled(c, _CENT)


def from_cents(c: Column | str) -> Column:
    return _col(c) / F.lit(float(_CENT))


def money_sum(c: Column | str) -> Column:
    return from_cents(F.sum(cents(c)))


def money_avg(c: Column | str) -> Column:
    return F.try_divide(money_sum(c), F.count(_col(c)))


def rate_avg(c: Column | str) -> Column:
    """Mean of ratios, each taken to nine decimals. Summed wide: used on marts, not on claims."""
    scaled = F.rint(_col(c) * F.lit(float(_RATE))).cast("decimal(20,0)")
    total = F.sum(scaled).cast("double") / F.lit(float(_RATE))
    return F.try_divide(total, F.count(_col(c)))


def count_stddev(c: Column | str) -> Column:
    """Sample standard deviation of whole numbers; null for fewer than two rows."""
    wide = _col(c).cast("decimal(19,0)")
    n = F.count(_col(c))
    spread = F.sum((wide * wide).cast("decimal(38,0)")).cast("double") - F.try_divide(
        F.sum(wide).cast("double") * F.sum(wide).cast("double"), n
    )
    return F.when(n > 1, F.sqrt(F.greatest(F.try_divide(spread, n - 1), F.lit(0.0))))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double; null when the denominator is zero or null."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(_col(numerator) * F.lit(100.0), _col(denominator).cast("double"))
