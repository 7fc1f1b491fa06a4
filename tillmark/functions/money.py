"""Exact money: amounts are whole minor units, 64-bit in a line and decimal in a sum.

Such sums do not depend on the order in which partitions arrive. Sums of one
customer or order stay in 64 bits (up to 9.2e16 currency units with cents, past
that ANSI arithmetic raises); measures and reports go through :func:`sum_minor`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_minor(amount: Column, digits: int = 2) -> Column:
    """Nearest minor unit (cents for two digits), halves to even on the binary value."""
    return F.rint(amount * 10**digits).cast("bigint")


def from_minor(units: Column, digits: int = 2) -> Column:
    return units.cast("double") / F.lit(10**digits)


def round_cents(amount: Column) -> Column:
    return F.rint(amount * 100) / F.lit(100)


def sum_minor(units: Column, only: Column | None = None) -> Column:
    """Sum of minor units, 0 for a group without a matching row; cannot overflow."""
    value = units if only is None else F.when(only, units)
    return F.coalesce(wide_sum(value), F.lit(0))


def wide_sum(units: Column) -> Column:
    """Sum in a decimal, which holds ten billion times the largest 64-bit number."""
    return F.sum(units.cast("decimal(28,0)"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
