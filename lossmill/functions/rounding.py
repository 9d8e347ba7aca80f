"""Rounding and zero-safe ratios.

The marts are defined with half-away-from-zero rounding of the scaled double.
Spark's ``round`` goes through a decimal instead and gives another result for
values such as 1.005; it is also slow, since it builds a BigDecimal per value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero after scaling by 10**digits."""
    scale = float(10**digits)
    scaled = value * F.lit(scale)
    nearest = F.rint(scaled)  # half to even; the ties are corrected below
    gap = scaled - nearest
    tie = (
        F.when((scaled > 0) & (gap == 0.5), 1.0)
        .when((scaled < 0) & (gap == -0.5), -1.0)
        .otherwise(0.0)
    )
    return (nearest + tie) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two amounts, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Zero-safe ratio as a rounded percentage."""
    return round_away(ratio(numerator, denominator) * 100.0, digits)


def settle(value: Column, digits: int) -> Column:
    """Round through DECIMAL(38,10).

    Sums of doubles differ in their last bits with the order of the rows. This
    form gives one result for all of them, and is meant for reported totals.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")
