import pytest
from pyspark.sql import functions as F

from lossmill.operators import modeling


@pytest.fixture
def policies(spark):
    rows = [(i, 0.5 + i / 100, i % 3, float(i * 10)) for i in range(1, 101)]
    frame = spark.createDataFrame(
        rows, "IDpol long, Exposure double, ReportedClaimCount long, UltimateLosses double"
    )
    extra = {name: F.lit("A") for name in ("Area", "Region")}
    numbers = {name: F.col("IDpol") for name in ("VehPower", "VehAge", "DrivAge", "BonusMalus")}
    return frame.withColumns({**extra, **numbers, "EarnedPremium": F.lit(100.0)})


def test_three_table_join_equals_the_rowwise_frame(policies):
    zero = policies.withColumn("Exposure", F.when(F.col("IDpol") > 3, F.col("Exposure")).otherwise(0.0))
    joined = modeling.modeling_dataset(zero, zero, zero)
    rowwise = modeling.modeling_columns(zero)
    assert joined.columns == rowwise.columns
    assert sorted(joined.collect()) == sorted(rowwise.collect())
    assert joined.count() == 97
    assert modeling.audit_dataset(zero, zero).count() == 97


def test_severity_needs_claims_and_a_loss(policies):
    some = policies.withColumn(
        "UltimateLosses", F.when(F.col("IDpol") <= 10, 0.0).otherwise(F.col("UltimateLosses"))
    )
    rows = modeling.severity_dataset(some).collect()
    assert len(rows) == sum(1 for i in range(11, 101) if i % 3)
    assert all(r["Avg_Severity"] == r["UltimateLosses"] / r["ReportedClaimCount"] for r in rows)


def test_cap_keeps_every_policy_with_claims(policies):
    pdf = policies.where("ReportedClaimCount > 0").toPandas()
    severity = pdf.UltimateLosses / pdf.ReportedClaimCount
    cap = modeling.severity_cap(policies)
    assert cap == pytest.approx(severity.quantile(0.99), rel=1e-14)
    capped = modeling.severity_capped(policies, cap).toPandas()
    assert sorted(capped.Avg_Severity) == sorted(severity.clip(upper=cap))
    assert modeling.severity_capped(policies, None).count() == len(pdf)


def test_flag_is_strict_and_class_balance(policies):
    pdf = policies.where("ReportedClaimCount > 0").toPandas()
    severity = pdf.UltimateLosses / pdf.ReportedClaimCount
    threshold = modeling.retention(policies)
    assert threshold == pytest.approx(severity.quantile(0.95), rel=1e-14)
    flagged = modeling.with_large_loss_flag(policies, threshold)
    large = int((severity > threshold).sum())
    found = modeling.class_balance(flagged).first()
    assert tuple(found) == (100, large, (100 - large) / large)
    exact = modeling.with_large_loss_flag(policies, float(severity.max()))
    assert tuple(modeling.class_balance(exact).first()) == (100, 0, None)


def test_mean_deviance(spark):
    frame = spark.createDataFrame([(0, 0.5), (1, 1.0)], "y long, mu double")
    found = modeling.mean_poisson_deviance(frame, "y", "mu").first()[0]
    assert found == pytest.approx(0.5)
