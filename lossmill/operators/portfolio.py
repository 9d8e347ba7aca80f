"""Policy portfolio: the exposure register with the claims of each policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PORTFOLIO_COLUMNS = (
    "IDpol", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
    "VehBrand", "VehGas", "Density", "Region",
)


def claims_per_policy(claims: DataFrame) -> DataFrame:
    """Claim total and number of known claim amounts per policy.

    Partial sums are formed before the shuffle, so a policy holding a large
    share of all claims sends one row per task and not all of its claims. Claims
    with a ``ClaimDate`` also give the first and the last one.
    """
    dates = []
    if "ClaimDate" in claims.columns:
        dates = [F.min("ClaimDate").alias("FirstClaim"), F.max("ClaimDate").alias("LastClaim")]
    return claims.groupBy("IDpol").agg(
        F.sum("ClaimAmount").alias("TotalClaimAmount"),
        F.count("ClaimAmount").alias("ActualClaimCount"),
        *dates,
    )


def attach_claims(register: DataFrame, totals: DataFrame) -> DataFrame:
    """Keep every policy; policies without claims get zero amounts."""
    joined = register.join(totals, "IDpol", "left")
    return joined.select(
        *register.columns,
        F.coalesce("TotalClaimAmount", F.lit(0.0)).alias("TotalClaimAmount"),
        F.coalesce("ActualClaimCount", F.lit(0)).cast("bigint").alias("PaidClaimCount"),
        *[c for c in ("FirstClaim", "LastClaim") if c in totals.columns],
    )


def policy_portfolio(register: DataFrame, claims: DataFrame) -> DataFrame:
    """Portfolio from the two registers; claims are totalled before the join."""
    joined = attach_claims(register, claims_per_policy(claims))
    return joined.select(
        *PORTFOLIO_COLUMNS,
        F.col("ClaimNb").alias("ReportedClaimCount"),
        "TotalClaimAmount",
        "PaidClaimCount",
    )


def portfolio_validation(portfolio: DataFrame) -> DataFrame:
    """Row counts in one pass: all, without claim amount, with claim amount."""
    amount = F.col("TotalClaimAmount")
    return portfolio.agg(
        F.count("*").alias("Total_Policies"),
        F.count_if(amount == 0).alias("Zero_Claim_Policies"),
        F.count_if(amount > 0).alias("Claim_Bearing_Policies"),
    )


def key_uniqueness(portfolio: DataFrame) -> DataFrame:
    """Check of the policy key; every join on it assumes one row per policy."""
    return (
        portfolio.groupBy("IDpol")
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("Total_Policies"),
            F.count("*").alias("Distinct_Keys"),
            F.max("n").alias("Most_Rows_Per_Key"),
        )
    )
