"""Star schema: policy dimension, financial fact and the monthly regional view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keyed import keyed_date
from ..functions.rounding import percent, ratio, round_away, settle
from ..params import Calendar
from .mart import MART_COLUMNS

DIMENSION_COLUMNS = (
    "IDpol", "Exposure", "Region", "Area", "VehPower", "VehAge", "DrivAge", "BonusMalus",
    "Claim_Frequency", "Underwriting_Date", "Underwriting_Month",
)


def underwriting_date(columns: list[str], calendar: Calendar = Calendar()) -> Column:
    """The portfolio's own date, or a keyed draw where it carries none."""
    if "Underwriting_Date" in columns:
        return F.col("Underwriting_Date")
    return keyed_date(F.col("IDpol"), calendar)


def with_dimension(policies: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    """Claim frequency, underwriting date and the month of that same date."""
    frequency = ratio(F.col("ReportedClaimCount"), F.col("Exposure"))
    return policies.withColumns(
        {
            "Claim_Frequency": round_away(frequency, 4),
            "Underwriting_Date": underwriting_date(policies.columns, calendar),
        }
    ).withColumn("Underwriting_Month", F.date_format("Underwriting_Date", "yyyy-MM"))


def dim_policies(portfolio: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    return with_dimension(portfolio, calendar).select(*DIMENSION_COLUMNS)


def fact_financials(mart: DataFrame) -> DataFrame:
    """The mart under its star-schema name; no copy is made until it is written."""
    return mart.select(*MART_COLUMNS)


def monthly_loss_ratios(policies: DataFrame) -> DataFrame:
    """Monthly loss ratio per region, with the change to the month before.

    ``policies`` has one row per policy with month, region, premium and losses.
    "The month before" is the region's previous month that has policies. The
    window runs on the aggregate, so a region holds one row per month.
    """
    premium, losses = F.col("Total_EarnedPremium"), F.col("Total_UltimateLosses")
    monthly = (
        policies.groupBy("Underwriting_Month", "Region")
        .agg(
            F.sum("EarnedPremium").alias("Total_EarnedPremium"),
            F.sum("UltimateLosses").alias("Total_UltimateLosses"),
        )
        .withColumn("Monthly_LR", percent(settle(losses, 4), settle(premium, 4)))
    )
    by_region = Window.partitionBy("Region").orderBy("Underwriting_Month")
    return monthly.withColumn("Prev_Month_LR", F.lag("Monthly_LR").over(by_region)).withColumn(
        "Delta_LR", round_away(F.col("Monthly_LR") - F.col("Prev_Month_LR"), 2)
    )


def monthly_regional_summary(dimension: DataFrame, fact: DataFrame) -> DataFrame:
    """The monthly view over the stored dimension and fact tables."""
    joined = dimension.select("IDpol", "Underwriting_Month", "Region").join(
        fact.select("IDpol", "EarnedPremium", "UltimateLosses"), "IDpol"
    )
    return monthly_loss_ratios(joined)


def region_month_sample(
    summary: DataFrame, region: str, from_month: str, months: int = 3
) -> DataFrame:
    """First months of one region from a given month on."""
    return (
        summary.where((F.col("Region") == region) & (F.col("Underwriting_Month") >= from_month))
        .select("Region", "Underwriting_Month", "Monthly_LR", "Delta_LR")
        .orderBy("Underwriting_Month")
        .limit(months)
    )
