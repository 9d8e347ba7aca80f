"""A third and more of the rows under one key."""

from pyspark.sql import functions as F

from lossmill.operators import boosting as bt
from lossmill.operators import insights, portfolio, star


def hot():
    """Key 7 for a third of the rows, otherwise the row's own number."""
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))


def test_one_policy_with_a_third_of_all_claims(spark):
    claims = spark.range(30_000).select(hot().alias("IDpol"), F.lit(2.0).alias("ClaimAmount"))
    totals = portfolio.claims_per_policy(claims)
    found = totals.where("IDpol = 7").first()
    assert tuple(found) == (7, 2.0 * 10_001, 10_001)
    assert totals.agg(F.sum("ActualClaimCount")).first()[0] == 30_000
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.index("functions=[sum") < plan.index("Exchange") < plan.index("partial_sum")


def test_one_month_and_region_with_a_third_of_all_policies(spark):
    policies = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "2024-01").otherwise(
            F.concat(F.lit("2023-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"))
        ).alias("Underwriting_Month"),
        F.lit("R1").alias("Region"),
        F.lit(100.0).alias("EarnedPremium"),
        F.lit(50.0).alias("UltimateLosses"),
    )
    rows = star.monthly_loss_ratios(policies).collect()
    assert sum(r["Total_EarnedPremium"] for r in rows) == 900_000.0
    assert {r["Monthly_LR"] for r in rows} == {50.0}
    assert {r["Delta_LR"] for r in rows} == {None, 0.0}


def test_one_cell_with_a_third_of_all_policies(spark):
    policies = spark.range(3_000).select(
        F.col("id").alias("IDpol"),
        F.lit(1.0).alias("Exposure"),
        F.lit("A").alias("Area"),
        F.lit("R1").alias("Region"),
        F.lit(5).cast("long").alias("VehPower"),
        F.lit(1).cast("long").alias("VehAge"),
        F.lit(30).cast("long").alias("DrivAge"),
        (hot() % 100).cast("long").alias("BonusMalus"),
        (F.col("id") % 2).alias("ReportedClaimCount"),
        (F.col("id") % 2 * 100.0).alias("UltimateLosses"),
        F.lit(300.0).alias("EarnedPremium"),
    )
    prepared = insights.rating_cells(policies)
    cells, _ = insights.fit_frequency(prepared.cells, bt.Boosting(rounds=1, depth=2))
    assert cells.count() == 100
    scored = insights.score_policies(prepared.policies, cells)
    assert scored.count() == 3_000 and scored.select("IDpol").distinct().count() == 3_000


def test_one_combination_with_a_third_of_all_policies(spark):
    """The same with the model that `fit_frequency` returns."""
    policies = spark.range(3_000).select(
        F.col("id").alias("IDpol"),
        F.lit(1.0).alias("Exposure"),
        F.lit("A").alias("Area"),
        F.lit("R1").alias("Region"),
        F.lit(5).cast("long").alias("VehPower"),
        F.lit(1).cast("long").alias("VehAge"),
        F.lit(30).cast("long").alias("DrivAge"),
        (hot() % 100).cast("long").alias("BonusMalus"),
        (F.col("id") % 2).alias("ReportedClaimCount"),
        (F.col("id") % 2 * 100.0).alias("UltimateLosses"),
        F.lit(300.0).alias("EarnedPremium"),
    )
    prepared = insights.rating_cells(policies)
    model = insights.fit_frequency(prepared.cells, bt.Boosting(rounds=1, depth=2))
    assert prepared.cells.count() == 100
    scored = bt.margins(prepared.policies, {"margin": model})
    assert scored.count() == 3_000 and scored.select("IDpol").distinct().count() == 3_000
