"""Money sums that do not depend on the order of addition.

Prices carry two decimals but are stored as doubles in the star schema. A sum of
doubles changes in its last digits with the partitioning, so amounts are added as
whole cents. These are held in two numbers, the multiples of ``LIMB`` and the rest, added
up each by itself: long buffers keep the aggregation in generated code (a wide decimal does
not), and no sum wraps, whether ANSI mode is on or not, below two million million rows and 2**63
multiples of ``LIMB`` cents. Both are put together once, as a decimal of 38 digits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

LIMB = 1 << 22


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def _limbs(amount: Column | str) -> tuple[Column, Column]:
    """Whole cents as multiples of ``LIMB`` and the rest, which is not negative. Dividing a double
    by a power of two is exact. NaN is no amount."""
    cents = F.rint(F.nanvl(_column(amount).cast("double"), F.lit(None).cast("double")) * 100)
    high = F.floor(cents / LIMB)
    return high, (cents - high.cast("double") * LIMB).cast("bigint")


def cents(amount: Column | str) -> Column:
    """Aggregate: the exact sum of a two-decimal amount in cents, for ``from_cents`` and
    ``total_cents``; null where there is none."""
    high, low = _limbs(amount)
    return F.struct(F.sum(high).alias("high"), F.sum(low).alias("low"))


def total_cents(sums: str) -> Column:
    """Aggregate: the sum of sums."""
    return F.struct(F.sum(f"{sums}.high").alias("high"), F.sum(f"{sums}.low").alias("low"))


def _dollars(high: Column, low: Column) -> Column:
    total = high.cast("decimal(20,0)") * F.lit(Decimal(LIMB)) + low.cast("decimal(20,0)")
    return total * F.lit(Decimal("0.01"))


def from_cents(sums: Column | str) -> Column:
    """A sum of cents as a double, rounded once from the exact decimal value."""
    sums = _column(sums)
    return _dollars(sums["high"], sums["low"]).cast("double")


def exact_sum(amount: Column | str) -> Column:
    """Aggregate: the exact sum of a two-decimal amount, as a double."""
    return from_cents(cents(amount))


def exact_difference(amount: Column | str, less: Column | str) -> Column:
    """One two-decimal amount less another, as a double, rounded once."""
    return (_dollars(*_limbs(amount)) - _dollars(*_limbs(less))).cast("double")


def average(total: Column, count: Column) -> Column:
    """``total / count``, null where nothing was counted."""
    return F.try_divide(total, count)
