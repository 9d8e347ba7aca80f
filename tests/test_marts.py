import pytest
from pyspark.sql import functions as F

from lossmill.operators import mart, portfolio as pf, reserving, star
from lossmill.params import Tariff


def by_key(frame):
    return {r["IDpol"]: r for r in frame.collect()}


def test_claims_are_totalled_and_every_policy_kept(spark):
    register = spark.createDataFrame(
        [(1, 2, 0.5), (2, 0, 1.0), (3, 1, 1.0)], "IDpol long, ClaimNb long, Exposure double"
    )
    for name in pf.PORTFOLIO_COLUMNS[2:]:
        register = register.withColumn(name, F.lit(1))
    claims = spark.createDataFrame(
        [(1, 10.0), (1, 5.5), (3, None), (9, 7.0)], "IDpol long, ClaimAmount double"
    )
    rows = by_key(pf.policy_portfolio(register, claims))
    found = {
        k: (r["ReportedClaimCount"], r["TotalClaimAmount"], r["PaidClaimCount"])
        for k, r in rows.items()
    }
    assert found == {1: (2, 15.5, 2), 2: (0, 0.0, 0), 3: (1, 0.0, 0)}


def test_validation_counts(portfolio):
    assert tuple(pf.portfolio_validation(portfolio).first()) == (6, 3, 3)
    twice = portfolio.union(portfolio.where("IDpol = 1"))
    assert tuple(pf.key_uniqueness(twice).first()) == (7, 6, 2)


def test_status_boundaries(spark):
    claims = spark.createDataFrame(
        [(1, 91.0, 0.0), (2, 90.0, 1.0), (3, 90.0, 0.0), (4, 90.5, 0.4), (5, 89.5, 0.5)],
        "IDpol long, ReportingDelay double, PaymentDelay double",
    ).withColumn("TotalClaimAmount", F.lit(100.0))
    rows = by_key(reserving.claims_reserving(claims))
    # Halves go to the even day: 90.5 and 89.5 both become 90.
    assert [rows[k]["Status"] for k in sorted(rows)] == [
        "IBNR", "Reported_Open", "Paid_Closed", "Paid_Closed", "Paid_Closed",
    ]
    for r in rows.values():
        buckets = [r["PaidAmount"], r["CaseReserve"], r["IBNRReserve"]]
        assert sum(buckets) == r["UltimateLoss"] == 100.0 and sorted(buckets)[:2] == [0, 0]


def test_reserve_totals_add_up(spark):
    claims = spark.range(500).select(
        F.col("id").alias("IDpol"), (F.col("id") % 7).cast("double").alias("TotalClaimAmount")
    )
    reserved = reserving.claims_reserving(claims)
    assert reserved.count() == claims.where("TotalClaimAmount > 0").count()
    assert {r[0] for r in reserved.select("Status").distinct().collect()} == {
        "IBNR", "Reported_Open", "Paid_Closed",
    }
    totals = reserving.reserve_totals(reserved).first()
    assert sum(totals) == claims.agg(F.sum("TotalClaimAmount")).first()[0]


def test_tariff_cases(portfolio):
    rows = by_key(portfolio.select("IDpol", mart.earned_premium().alias("p")))
    # At 25 there is no discount yet, above it there is; an unknown age has none.
    assert rows[1]["p"] == 450.0 and rows[2]["p"] == 400.0
    assert rows[4]["p"] == (250 + 105 + 137.5) * 0.5
    dearer = by_key(portfolio.select("IDpol", mart.earned_premium(Tariff(base=300.0)).alias("p")))
    assert dearer[1]["p"] == 500.0


def test_join_and_rowwise_marts_agree(portfolio):
    joined = mart.financial_mart(portfolio, reserving.claims_reserving(portfolio))
    rowwise = mart.policy_ledger(portfolio).select(*mart.MART_COLUMNS)
    assert by_key(joined) == by_key(rowwise)
    assert joined.columns == list(mart.MART_COLUMNS)


def test_ratios_and_treaty(portfolio):
    rows = by_key(mart.policy_ledger(portfolio))
    assert rows[3]["LossRatio"] is None and rows[3]["CombinedRatio"] is None
    for key in (1, 2, 4, 5, 6):
        r = rows[key]
        assert r["CombinedRatio"] == pytest.approx(r["LossRatio"] + r["ExpenseRatio"], abs=0.011)
        assert r["ReinsurerCededPremium"] == pytest.approx(r["EarnedPremium"] / 2, abs=0.006)
        assert r["UnderwritingExpenses"] == pytest.approx(
            (30 + r["TotalClaimAmount"] * 0.05) * r["Exposure"]
        )
        assert r["ReinsuranceCedingCommission"] == pytest.approx(
            r["UnderwritingExpenses"] * 0.15, abs=0.006
        )


def test_ibnr_is_added_only_when_asked(spark, portfolio):
    late = spark.createDataFrame([(2, 0.0, 0.0, 900.0)], "IDpol long, PaidAmount double, CaseReserve double, IBNRReserve double")
    assert by_key(mart.financial_mart(portfolio, late))[2]["UltimateLosses"] == 1800.0
    plain = by_key(mart.financial_mart(portfolio, late, ibnr_additive=False))
    assert plain[2]["UltimateLosses"] == 900.0 and plain[2]["IBNRReserves"] == 900.0
    assert plain[1]["PaidLosses"] == 0.0


def test_portfolio_ratios_are_ratios_of_sums(spark, portfolio):
    ledger = mart.policy_ledger(portfolio)
    pdf = ledger.toPandas()
    found = mart.portfolio_ratios(ledger).first()
    premium = pdf.EarnedPremium.sum()
    assert found["Portfolio_Loss_Ratio"] == round(pdf.UltimateLosses.sum() / premium * 100, 2)
    assert found["Portfolio_Expense_Ratio"] == round(
        pdf.UnderwritingExpenses.sum() / premium * 100, 2
    )
    assert tuple(mart.portfolio_ratios(ledger.where("Exposure = 0")).first()) == (None,) * 3


def test_dimension(portfolio):
    rows = by_key(star.dim_policies(portfolio))
    assert rows[3]["Claim_Frequency"] is None
    assert rows[6]["Claim_Frequency"] == 1.3333
    assert rows[6]["Underwriting_Month"] == "2024-04"
    drawn = star.dim_policies(portfolio.drop("Underwriting_Date")).collect()
    assert all(r["Underwriting_Month"] == r["Underwriting_Date"].strftime("%Y-%m") for r in drawn)


def test_previous_month_is_the_previous_present_month(portfolio):
    ledger = mart.policy_ledger(portfolio)
    summary = star.monthly_regional_summary(
        star.dim_policies(portfolio), star.fact_financials(ledger)
    )
    rows = {(r["Region"], r["Underwriting_Month"]): r for r in summary.collect()}
    assert set(rows) == {("R1", "2024-01"), ("R1", "2024-03"), ("R2", "2024-03"), ("R2", "2024-04")}
    first, later = rows["R1", "2024-01"], rows["R1", "2024-03"]
    assert first["Prev_Month_LR"] is None and first["Delta_LR"] is None
    assert later["Prev_Month_LR"] == first["Monthly_LR"]
    assert later["Delta_LR"] == pytest.approx(later["Monthly_LR"] - first["Monthly_LR"], abs=0.006)
    rowwise = star.monthly_loss_ratios(star.with_dimension(ledger)).collect()
    assert {(r["Region"], r["Underwriting_Month"]): r for r in rowwise} == rows
    sample = star.region_month_sample(summary, "R1", "2024-02").collect()
    assert [(r["Underwriting_Month"], r["Delta_LR"]) for r in sample] == [
        ("2024-03", later["Delta_LR"])
    ]
