import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmill.operators import modeling
from lossmill.operators.quantile import exact_quantile, exact_quantiles

RNG = np.random.default_rng(7)
SAMPLES = {
    "spread": RNG.lognormal(7, 1.5, 5000),
    "hot value": np.r_[np.zeros(3000), np.full(2500, 5.0), RNG.normal(5, 1, 2000)],
    "few values": RNG.integers(0, 4, 4000).astype(float),
    "one row": np.array([3.5]),
    "constant": np.full(700, 2.0),
}


@pytest.mark.parametrize("sample", SAMPLES)
def test_equals_the_sorted_interpolation(spark, sample):
    values = SAMPLES[sample]
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    for share in (0.0, 0.37, 0.95, 0.99, 1.0):
        found = exact_quantile(frame, "x", share)
        assert found == pytest.approx(np.quantile(values, share), rel=1e-14)


def test_no_values(spark):
    frame = spark.createDataFrame([(None,)], "x double")
    assert exact_quantile(frame, "x", 0.5) is None


def test_several_quantiles_share_their_passes(spark):
    frame = spark.createDataFrame([(float(v), i % 3) for i, v in enumerate(SAMPLES["spread"])], "x double, k int")
    wanted = [(F.col("x"), 0.99), (F.when(F.col("k") == 1, F.col("x")), 0.95), (F.when(F.col("k") == 7, F.col("x")), 0.5), (F.col("x"), 0.2)]
    some = SAMPLES["spread"][np.arange(5000) % 3 == 1]
    found = exact_quantiles(frame, wanted)
    assert found[2] is None
    want = [np.quantile(SAMPLES["spread"], 0.99), np.quantile(some, 0.95), np.quantile(SAMPLES["spread"], 0.2)]
    assert [found[0], found[1], found[3]] == pytest.approx(want, rel=1e-14)


def test_extreme_values(spark):
    values = [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-300, -2.0]
    frame = spark.createDataFrame([(v,) for v in [*values, float("nan"), float("inf")]], "x double")
    found = exact_quantiles(frame, [(F.col("x"), i / 5) for i in range(6)])
    assert found == sorted(values)


def test_values_are_not_sorted(spark, monkeypatch):
    from lossmill.operators import quantile

    plans, histograms = [], quantile._histograms

    def spied(values, bounds):
        plans.append(values._jdf.queryExecution().executedPlan().toString())
        return histograms(values, bounds)

    monkeypatch.setattr(quantile, "_histograms", spied)
    exact_quantile(spark.range(3000).select((F.col("id") * 7 % 3000).cast("double").alias("x")), "x", 0.37)
    assert 0 < len(plans) < 5 and not any("Sort" in p or "Exchange" in p for p in plans)


def test_cap_and_retention_together(spark):
    rows = [(i % 3, float(i % 50)) for i in range(500)]
    frame = spark.createDataFrame(rows, "ReportedClaimCount long, UltimateLosses double")
    assert modeling.thresholds(frame) == (modeling.severity_cap(frame), modeling.retention(frame))
