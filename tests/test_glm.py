import math

import numpy as np
import pandas as pd
import pytest

from lossmill.operators import glm, modeling

N = 3000


@pytest.fixture(scope="module")
def policies():
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "IDpol": np.arange(N),
            "Exposure": rng.integers(1, 13, N) / 12,
            "Area": rng.choice(list("ABC"), N),
            "Region": "R1",
            "VehPower": rng.integers(4, 8, N),
            "VehAge": rng.integers(0, 5, N),
            "DrivAge": rng.integers(20, 26, N),
            "BonusMalus": rng.integers(50, 54, N),
        }
    )
    rate = np.exp(-0.2 + 0.1 * (pdf.VehPower - 5) + 0.4 * (pdf.Area == "B"))
    pdf["ReportedClaimCount"] = rng.poisson(rate * pdf.Exposure)
    cost = rng.gamma(2.0, np.exp(6 + 0.2 * pdf.VehAge) / 2.0)
    pdf["UltimateLosses"] = np.where(pdf.ReportedClaimCount > 0, cost, 0.0)
    pdf.loc[pdf.index[pdf.ReportedClaimCount > 0][:20], "UltimateLosses"] = 0.0
    pdf["EarnedPremium"] = 100.0
    pdf["Log_Exposure"] = np.log(pdf.Exposure)
    return pdf


def design(pdf):
    areas = [(pdf.Area == a).astype(float) for a in ("C", "B")]
    numeric = [pdf[n].astype(float) for n in ("VehPower", "VehAge", "DrivAge", "BonusMalus")]
    return np.column_stack([*numeric, *areas, np.ones(len(pdf))])


def irls(x, y, offset, variance):
    """Plain iteratively reweighted least squares for a log link, row by row."""
    beta = np.zeros(x.shape[1])
    beta[-1] = math.log(y.mean())
    for _ in range(100):
        mu = np.exp(x @ beta + offset)
        weight = mu**2 / variance(mu)
        z = x @ beta + (y - mu) / mu
        beta = np.linalg.solve(x.T @ (x * weight[:, None]), x.T @ (weight * z))
    mu = np.exp(x @ beta + offset)
    covariance = np.linalg.inv(x.T @ (x * (mu**2 / variance(mu))[:, None]))
    return beta, mu, covariance


def check(table, beta, errors):
    assert list(table.Term) == [
        "VehPower", "VehAge", "DrivAge", "BonusMalus", "Area_C", "Area_B", "Intercept",
    ]
    assert np.allclose(table.Coefficient, beta, rtol=1e-5, atol=1e-7)
    assert np.allclose(table.Std_Error, errors, rtol=1e-5)
    assert np.allclose(table.Z_Value, beta / errors, rtol=1e-4, atol=1e-5)
    p = [math.erfc(abs(z) / math.sqrt(2)) for z in beta / errors]
    assert np.allclose(table.P_Value, p, atol=1e-5)
    assert np.allclose(table.Upper_95 - table.Lower_95, 2 * 1.959964 * errors, rtol=1e-5)


def test_grouped_poisson_fit_equals_the_row_fit(spark, policies):
    fitted = glm.fit_frequency_glm(spark.createDataFrame(policies))
    assert fitted.design.count() < N
    y = policies.ReportedClaimCount.to_numpy(float)
    beta, _, cov = irls(design(policies), y, np.log(policies.Exposure.to_numpy()), lambda mu: mu)
    check(fitted.coefficients().toPandas(), beta, np.sqrt(np.diag(cov)))


def test_grouped_gamma_fit_equals_the_row_fit(spark, policies):
    frame = spark.createDataFrame(policies)
    fitted = glm.fit_severity_glm(frame)
    claims = policies[policies.ReportedClaimCount > 0]
    severity = claims.UltimateLosses / claims.ReportedClaimCount
    severity = severity.clip(upper=severity.quantile(0.99))
    claims, y = claims[severity > 0], severity[severity > 0].to_numpy()
    x = design(claims)
    beta, mu, cov = irls(x, y, 0.0, lambda mu: mu**2)
    dispersion = (((y - mu) / mu) ** 2).sum() / (len(y) - x.shape[1])
    assert fitted.dispersion == pytest.approx(dispersion, rel=1e-6)
    check(fitted.coefficients().toPandas(), beta, np.sqrt(np.diag(cov) * dispersion))


def test_policies_with_unknown_factors_are_left_out(spark, policies):
    frame = spark.createDataFrame(policies)
    unknown = frame.limit(5).selectExpr(
        *[f"CAST(NULL AS STRING) AS {c}" if c == "Area" else c for c in frame.columns]
    )
    with_gap = glm.fit_frequency_glm(frame.unionByName(unknown)).coefficients().toPandas()
    without = glm.fit_frequency_glm(frame).coefficients().toPandas()
    assert np.allclose(with_gap.Coefficient, without.Coefficient, rtol=1e-9)
