"""Financial mart: premium, losses, expenses, ratios and the quota share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import percent, round_away, settle
from ..params import Expenses, QuotaShare, Reserving, Tariff
from .reserving import with_delays, with_reserves

MART_COLUMNS = (
    "IDpol", "Exposure", "Region", "EarnedPremium", "PaidLosses", "CaseReserves",
    "IBNRReserves", "UltimateLosses", "UnderwritingExpenses", "LossRatio", "ExpenseRatio",
    "CombinedRatio", "ReinsurerCededPremium", "ReinsurerCededLosses",
    "ReinsuranceCedingCommission",
)


def earned_premium(tariff: Tariff = Tariff()) -> Column:
    """Tariff premium earned over the exposure; an unknown age gets no discount."""
    discount = F.when(F.col("DrivAge") > tariff.discount_above_age, tariff.discount).otherwise(0)
    annual = (
        F.lit(tariff.base)
        + F.col("VehPower") * tariff.per_power
        - discount
        + F.col("BonusMalus") * tariff.per_malus
    )
    return annual * F.col("Exposure")


def underwriting_expenses(expenses: Expenses = Expenses()) -> Column:
    per_year = F.lit(expenses.fixed) + F.col("TotalClaimAmount") * expenses.claim_share
    return per_year * F.col("Exposure")


def with_financials(
    policies: DataFrame,
    tariff: Tariff = Tariff(),
    expenses: Expenses = Expenses(),
    ibnr_additive: bool = True,
) -> DataFrame:
    """Premium, losses, expenses and ratios from policy and reserve columns.

    The mart's established definition adds the IBNR reserve to a total that
    already holds those claims. ``ibnr_additive=False`` gives the plain total.
    """
    total = F.col("TotalClaimAmount")
    ibnr = F.coalesce("IBNRReserve", F.lit(0.0))
    premium, losses = F.col("EarnedPremium"), F.col("UltimateLosses")
    cost = F.col("UnderwritingExpenses")
    return policies.withColumns(
        {
            "PaidLosses": F.coalesce("PaidAmount", F.lit(0.0)),
            "CaseReserves": F.coalesce("CaseReserve", F.lit(0.0)),
            "IBNRReserves": ibnr,
            "UltimateLosses": total + ibnr if ibnr_additive else total,
            "EarnedPremium": earned_premium(tariff),
            "UnderwritingExpenses": underwriting_expenses(expenses),
        }
    ).withColumns(
        {
            "LossRatio": percent(losses, premium),
            "ExpenseRatio": percent(cost, premium),
            "CombinedRatio": percent(losses + cost, premium),
        }
    )


def with_quota_share(financials: DataFrame, treaty: QuotaShare = QuotaShare()) -> DataFrame:
    """Ceded premium, ceded losses and the commission paid back on expenses."""
    return financials.withColumns(
        {
            "ReinsurerCededPremium": round_away(F.col("EarnedPremium") * treaty.ceded, 2),
            "ReinsurerCededLosses": round_away(F.col("UltimateLosses") * treaty.ceded, 2),
            "ReinsuranceCedingCommission": round_away(
                F.col("UnderwritingExpenses") * treaty.commission, 2
            ),
        }
    )


def financial_mart(
    portfolio: DataFrame,
    claims: DataFrame,
    tariff: Tariff = Tariff(),
    expenses: Expenses = Expenses(),
    treaty: QuotaShare = QuotaShare(),
    ibnr_additive: bool = True,
) -> DataFrame:
    """Mart from the portfolio and a separate claims table, joined on the policy."""
    reserves = claims.select("IDpol", "PaidAmount", "CaseReserve", "IBNRReserve")
    joined = portfolio.join(reserves, "IDpol", "left")
    return with_quota_share(
        with_financials(joined, tariff, expenses, ibnr_additive), treaty
    ).select(*MART_COLUMNS)


def policy_ledger(
    portfolio: DataFrame,
    reserving: Reserving = Reserving(),
    tariff: Tariff = Tariff(),
    expenses: Expenses = Expenses(),
    treaty: QuotaShare = QuotaShare(),
    ibnr_additive: bool = True,
) -> DataFrame:
    """The portfolio with its mart columns, derived row by row.

    Reserves are a function of the policy's own row when they are drawn here,
    so joining the claims table back onto the portfolio it came from would only
    add a second scan and shuffle. Equal to ``financial_mart`` on
    ``claims_reserving`` of the same portfolio while policy keys are unique.
    """
    reserved = with_reserves(with_delays(portfolio, reserving), reserving)
    return with_quota_share(with_financials(reserved, tariff, expenses, ibnr_additive), treaty)


def portfolio_ratios(mart: DataFrame) -> DataFrame:
    """Portfolio loss, expense and combined ratio as ratios of sums."""
    totals = mart.agg(
        F.sum("UltimateLosses").alias("losses"),
        F.sum("UnderwritingExpenses").alias("cost"),
        F.sum(F.col("UltimateLosses") + F.col("UnderwritingExpenses")).alias("both"),
        F.sum("EarnedPremium").alias("premium"),
    )
    # Sums of doubles depend on the order of the rows in their last bits.
    losses, cost, both, premium = (settle(F.col(c), 4) for c in ("losses", "cost", "both", "premium"))
    return totals.select(
        percent(losses, premium).alias("Portfolio_Loss_Ratio"),
        percent(cost, premium).alias("Portfolio_Expense_Ratio"),
        percent(both, premium).alias("Portfolio_Combined_Ratio"),
    )
