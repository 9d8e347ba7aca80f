"""Business parameters. The defaults are fixed values: they decide the results."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Rating factors, in the order the models use them.
NUMERIC_FACTORS = ("VehPower", "VehAge", "DrivAge", "BonusMalus")
CATEGORY_FACTORS = ("Area", "Region")
RATING_FACTORS = ("Area", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Region")


@dataclass(frozen=True)
class Tariff:
    """Annual premium: base + power + malus, less a discount for older drivers."""

    base: float = 250.0
    per_power: float = 15.0
    discount: int = 50
    discount_above_age: int = 25
    per_malus: float = 2.5


@dataclass(frozen=True)
class Expenses:
    """Underwriting expense: a fixed sum plus a share of the claim amount."""

    fixed: float = 30.0
    claim_share: float = 0.05


@dataclass(frozen=True)
class QuotaShare:
    """Proportional treaty: ceded share and the commission on expenses."""

    ceded: float = 0.5
    commission: float = 0.15


@dataclass(frozen=True)
class Delay:
    """Lognormal delay in days."""

    mu: float
    sigma: float


@dataclass(frozen=True)
class Reserving:
    """Valuation day and the delay laws used where delays are not supplied."""

    valuation_day: int = 90
    reporting: Delay = field(default_factory=lambda: Delay(1.5, 1.2))
    payment: Delay = field(default_factory=lambda: Delay(3.0, 1.5))


@dataclass(frozen=True)
class Calendar:
    """Underwriting dates used where the portfolio carries none."""

    first_day: date = date(2024, 1, 1)
    days: int = 880


@dataclass(frozen=True)
class Leakage:
    """Segments whose technical loss ratio is far above the premium charged."""

    ratio_above: float = 150.0
    policies_above: int = 50
    top: int = 10


SEVERITY_CAP_QUANTILE = 0.99
RETENTION_QUANTILE = 0.95
