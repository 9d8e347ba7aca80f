"""Actuarial loss expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_exposure(exposure: Column) -> Column:
    """Offset of the frequency models; NULL for exposure <= 0."""
    return F.log(exposure)


def average_severity(losses: Column, claims: Column) -> Column:
    """Loss per claim, NULL without claims."""
    return losses / F.nullif(claims, F.lit(0))


def poisson_deviance(actual: Column, expected: Column) -> Column:
    """Unit Poisson deviance; the log term vanishes for a zero count."""
    log_term = F.when(actual > 0, actual * F.log(actual / expected)).otherwise(0.0)
    return (log_term - (actual - expected)) * 2.0
