"""Column builders for amounts: tolerance, rates, variance. Decimal arithmetic throughout."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT, RATE = "decimal(18,4)", "decimal(18,8)"


def exact(value: float | str) -> Column:
    """A decimal literal (never a double)."""
    return F.lit(Decimal(str(value)))


def within_tolerance(ours: Column, theirs: Column, absolute: float | str, relative: float | str) -> Column:
    """True if the amounts differ by no more than the larger of the two bounds; the relative one is of ``ours``. NULL amounts are not within."""
    bound = F.greatest(exact(absolute).cast("decimal(28,8)"), (exact(relative) * F.abs(ours)).cast("decimal(28,8)"))
    return F.coalesce(F.abs(ours - theirs).cast("decimal(28,8)") <= bound, F.lit(False))


def variance(ours: Column, theirs: Column) -> Column:
    zero = F.lit(0).cast(AMOUNT)
    return (F.coalesce(ours, zero) - F.coalesce(theirs, zero)).cast(AMOUNT)


def converted(amount: Column, rate: Column) -> Column:
    """amount * rate in the amounts' type, rounded half up."""
    return F.round(amount * rate, 4).cast(AMOUNT)
