"""Adapter from order and line-item tables to policy and claim registers.

Orders play the policies, returned and finished line items play the claims.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import settle


def claim_register(spark: SparkSession, folder: str) -> DataFrame:
    """One row per claim."""
    return (
        spark.read.parquet(f"{folder}/lineitem.parquet")
        .where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
        .select(
            F.col("l_orderkey").alias("IDpol"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("ClaimAmount"),
            F.col("l_shipdate").cast("date").alias("ClaimDate"),
        )
    )


def exposure_register(spark: SparkSession, folder: str) -> DataFrame:
    """One row per policy, with a real underwriting date.

    The nation names join the customers first, which leaves the orders one
    shuffle on the customer. Small sides are broadcast or not by the optimizer's
    own size check.
    """
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    owners = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    key, owner = F.col("o_orderkey"), F.col("o_custkey")
    return (
        orders.join(owners, owner == F.col("c_custkey"))
        .select(
            key.alias("IDpol"),
            ((key % 13).cast("double") / F.lit(12.0)).alias("Exposure"),
            F.substring("o_orderpriority", 1, 1).alias("Area"),
            (owner % 12 + 4).alias("VehPower"),
            F.floor(F.col("o_totalprice") / 25000.0).cast("bigint").alias("VehAge"),
            ((owner * 7 + key) % 70 + 18).alias("DrivAge"),
            (key % 101 + 50).alias("BonusMalus"),
            F.col("c_mktsegment").alias("VehBrand"),
            F.col("o_orderstatus").alias("VehGas"),
            F.floor(F.abs("c_acctbal")).cast("bigint").alias("Density"),
            F.col("n_name").alias("Region"),
            F.col("o_orderdate").cast("date").alias("Underwriting_Date"),
        )
    )


def policy_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """Policy portfolio of the order book.

    The register has no claim count of its own, so the count of its claims is
    taken for it. Amounts are settled to cents, which removes both the noise of
    the summation order and negative zeros. Reported is the day of the first claim,
    paid that of the last; a claim dated before the policy counts from its start.
    """
    from ..operators.portfolio import attach_claims, claims_per_policy

    joined = attach_claims(
        exposure_register(spark, folder), claims_per_policy(claim_register(spark, folder))
    )
    return joined.select(
        "IDpol", "Exposure", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
        "VehBrand", "VehGas", "Density", "Region",
        F.col("PaidClaimCount").alias("ReportedClaimCount"),
        settle(F.col("TotalClaimAmount"), 2).alias("TotalClaimAmount"),
        "PaidClaimCount",
        "Underwriting_Date",
        _days("Underwriting_Date", "FirstClaim").alias("ReportingDelay"),
        _days("FirstClaim", "LastClaim").alias("PaymentDelay"),
    )


def _days(start: str, end: str):
    """Days from one date to the other; a date before the start counts as the start."""
    days = F.date_diff(end, start).cast("double")
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0.0)))
