"""Datasets, targets and thresholds of the pricing models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.losses import average_severity, log_exposure, poisson_deviance
from ..params import RATING_FACTORS, RETENTION_QUANTILE, SEVERITY_CAP_QUANTILE
from .quantile import exact_quantile, exact_quantiles

MODELING_COLUMNS = (
    "IDpol", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus", "Region",
    "ReportedClaimCount", "UltimateLosses", "EarnedPremium",
)

AUDIT_COLUMNS = ("IDpol", *RATING_FACTORS, "ReportedClaimCount")


def modeling_columns(policies: DataFrame) -> DataFrame:
    """Model columns of the policies that can carry a log-exposure offset."""
    return policies.where(F.col("Exposure") > 0).select(
        *MODELING_COLUMNS, log_exposure(F.col("Exposure")).alias("Log_Exposure")
    )


def modeling_dataset(dimension: DataFrame, fact: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Features, targets and premium joined from the three stored tables."""
    policies = (
        dimension.select("IDpol", "Exposure", *RATING_FACTORS)
        .where(F.col("Exposure") > 0)
        .join(fact.select("IDpol", "UltimateLosses", "EarnedPremium"), "IDpol")
        .join(portfolio.select("IDpol", "ReportedClaimCount"), "IDpol")
    )
    return modeling_columns(policies)


def audit_dataset(dimension: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Features and claim counts for the risk-driver audit."""
    return (
        dimension.where(F.col("Exposure") > 0)
        .select("IDpol", *RATING_FACTORS)
        .join(portfolio.select("IDpol", "ReportedClaimCount"), "IDpol")
        .select(*AUDIT_COLUMNS)
    )


def severity_dataset(modeling: DataFrame) -> DataFrame:
    """Policies with claims and a positive loss, with their loss per claim."""
    return modeling.where(
        (F.col("ReportedClaimCount") > 0) & (F.col("UltimateLosses") > 0)
    ).withColumn("Avg_Severity", _severity())


def severity_cap(modeling: DataFrame, share: float = SEVERITY_CAP_QUANTILE) -> float | None:
    """Severity quantile over all policies with claims, zero losses included."""
    return exact_quantile(_with_claims(modeling), "Avg_Severity", share)


def severity_capped(modeling: DataFrame, cap: float | None) -> DataFrame:
    """Policies with claims, their severity capped; an empty portfolio has no cap."""
    severity = F.col("Avg_Severity")
    bounded = severity if cap is None else F.least(severity, F.lit(cap))
    return _with_claims(modeling).withColumn("Avg_Severity", bounded)


def retention(modeling: DataFrame, share: float = RETENTION_QUANTILE) -> float | None:
    """Excess-of-loss retention: a quantile of the positive severities."""
    return exact_quantile(severity_dataset(modeling), "Avg_Severity", share)


def thresholds(
    modeling: DataFrame, cap: float = SEVERITY_CAP_QUANTILE, retained: float = RETENTION_QUANTILE
) -> tuple[float | None, float | None]:
    """Severity cap and retention together, in the same passes."""
    claims = F.when(F.col("ReportedClaimCount") > 0, _severity())
    positive = F.when(F.col("UltimateLosses") > 0, claims)
    found = exact_quantiles(modeling, [(claims, cap), (positive, retained)])
    return found[0], found[1]


def with_large_loss_flag(modeling: DataFrame, threshold: float | None) -> DataFrame:
    """1 where a policy with claims has a severity above the retention, else 0."""
    above = (F.col("ReportedClaimCount") > 0) & (_severity() > F.lit(threshold).cast("double"))
    return modeling.withColumn("Is_Large_Loss", F.when(above, 1).otherwise(0))


def class_balance(flagged: DataFrame) -> DataFrame:
    """Negatives per positive, NULL where there is no positive."""
    counts = flagged.agg(
        F.count("*").alias("Policies"), F.sum("Is_Large_Loss").alias("Large_Losses")
    )
    negatives = F.col("Policies") - F.col("Large_Losses")
    return counts.withColumn(
        "Class_Ratio", negatives / F.nullif(F.col("Large_Losses"), F.lit(0))
    )


def mean_poisson_deviance(scored: DataFrame, actual: str, expected: str | Column) -> DataFrame:
    """Mean unit deviance of expected against actual counts."""
    expected = F.col(expected) if isinstance(expected, str) else expected
    return scored.agg(
        F.avg(poisson_deviance(F.col(actual), expected)).alias("Mean_Poisson_Deviance")
    )


def _severity() -> Column:
    return average_severity(F.col("UltimateLosses"), F.col("ReportedClaimCount"))


def _with_claims(modeling: DataFrame) -> DataFrame:
    return modeling.where(F.col("ReportedClaimCount") > 0).withColumn("Avg_Severity", _severity())
