"""Claims reserving: delays, status at the valuation day, and reserves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keyed
from ..params import Reserving

DELAY_COLUMNS = ("ReportingDelayDays", "PaymentDelayDays", "TotalDelayDays")
CLAIM_COLUMNS = (
    "IDpol", "TotalClaimAmount", *DELAY_COLUMNS, "Status",
    "PaidAmount", "CaseReserve", "IBNRReserve", "UltimateLoss",
)


def with_delays(policies: DataFrame, law: Reserving = Reserving()) -> DataFrame:
    """Whole-day reporting, payment and total delay.

    Supplied ``ReportingDelay`` and ``PaymentDelay`` columns are used where the
    frame has them. Otherwise both are lognormal draws keyed by the policy, made
    for positive amounts only; other policies have no claim to delay.
    """
    if {"ReportingDelay", "PaymentDelay"} <= set(policies.columns):
        reporting, payment = F.col("ReportingDelay"), F.col("PaymentDelay")
        drawn = policies
    else:
        claimed = F.col("TotalClaimAmount") > 0
        drawn = policies.withColumn(
            "_digest", F.when(claimed, keyed.digest(F.col("IDpol"), "delay"))
        )
        first, second = keyed.normal_pair(
            keyed.uniform(F.col("_digest"), 0), keyed.uniform(F.col("_digest"), 1)
        )
        reporting = keyed.lognormal(first, law.reporting)
        payment = keyed.lognormal(second, law.payment)
    return (
        drawn.withColumns(
            {"ReportingDelayDays": F.rint(reporting), "PaymentDelayDays": F.rint(payment)}
        )
        .withColumn("TotalDelayDays", F.col("ReportingDelayDays") + F.col("PaymentDelayDays"))
        .drop("_digest", "ReportingDelay", "PaymentDelay")
    )


def with_reserves(claims: DataFrame, law: Reserving = Reserving()) -> DataFrame:
    """Status at the valuation day, and the positive amounts routed to three buckets."""
    amount = F.col("TotalClaimAmount")
    status = (
        F.when(F.col("ReportingDelayDays") > law.valuation_day, "IBNR")
        .when(F.col("TotalDelayDays") > law.valuation_day, "Reported_Open")
        .otherwise("Paid_Closed")
    )

    def routed(name: str):
        return F.when((F.col("Status") == name) & (amount > 0), amount).otherwise(0.0)

    return claims.withColumn("Status", status).withColumns(
        {
            "PaidAmount": routed("Paid_Closed"),
            "CaseReserve": routed("Reported_Open"),
            "IBNRReserve": routed("IBNR"),
            "UltimateLoss": amount,
        }
    )


def claim_delays(portfolio: DataFrame, law: Reserving = Reserving()) -> DataFrame:
    """Delays of the claim-bearing policies."""
    claims = portfolio.where(F.col("TotalClaimAmount") > 0)
    return with_delays(claims, law).select("IDpol", "TotalClaimAmount", *DELAY_COLUMNS)


def claims_reserving(portfolio: DataFrame, law: Reserving = Reserving()) -> DataFrame:
    """The claims fact table: one row per policy with a positive claim amount."""
    return with_reserves(claim_delays(portfolio, law), law).select(*CLAIM_COLUMNS)


def reserve_totals(claims: DataFrame) -> DataFrame:
    """Paid, case and not-yet-reported totals in one pass."""
    return claims.agg(
        F.sum("PaidAmount").alias("Total_Paid"),
        F.sum("CaseReserve").alias("Total_Case"),
        F.sum("IBNRReserve").alias("Total_IBNR"),
    )
