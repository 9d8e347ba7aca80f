"""Generalized linear models of claim frequency and severity.

Both models are fitted on groups of policies with equal factors. The score
equations depend on a group only through its sums, so the estimates are those
of the single policies while the iterations run over far fewer rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import NUMERIC_FACTORS
from ..session import cut_lineage
from .modeling import severity_cap, severity_capped

FORMULA_FACTORS = (*NUMERIC_FACTORS, "Area")
MAX_ITERATIONS = 100
TOLERANCE = 1e-8
NORMAL_95 = 1.959963984540054  # 97.5 % quantile of the standard normal

COEFFICIENT_SCHEMA = (
    "Term string, Coefficient double, Std_Error double, Z_Value double, "
    "P_Value double, Lower_95 double, Upper_95 double"
)


@dataclass
class FittedGlm:
    """Model, its design frame of grouped policies, their weights in the information, and the dispersion of the policies."""

    model: GeneralizedLinearRegressionModel
    design: DataFrame
    weight: str
    dispersion: float

    def fitted(self) -> DataFrame:
        """Grouped policies with the fitted mean ``Fitted``."""
        return self.model.transform(self.design).drop("features")

    def information(self) -> np.ndarray:
        """The matrix X'WX at the estimates, the intercept last: one aggregation of one row.

        With a log link W is the fitted count of a group for the Poisson family, and
        the number of its policies for the Gamma family.
        """
        size = len(self.model.coefficients) + 1
        x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
        rows = self.model.transform(self.design).select(x.alias("x"), F.col(self.weight).alias("w"))
        pairs = [(i, j) for i in range(size) for j in range(i, size)]
        sums = rows.agg(*[F.sum(F.col("w") * F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).first()
        matrix = np.zeros((size, size))
        for (i, j), value in zip(pairs, sums):
            matrix[i, j] = matrix[j, i] = value or 0.0
        return matrix

    def standard_errors(self) -> list[float | None]:
        """Roots of the diagonal of the dispersion times the inverted information; None for terms that cannot be told apart."""
        matrix = self.information()
        scale = np.sqrt(np.maximum(np.diag(matrix), np.finfo(float).tiny))
        scaled = matrix / np.outer(scale, scale)
        if np.linalg.matrix_rank(scaled, hermitian=True) < len(scaled):
            return [None] * len(scaled)
        return np.sqrt(self.dispersion * np.diag(np.linalg.inv(scaled)) / scale**2).tolist()

    def coefficients(self) -> DataFrame:
        """Estimate, standard error, z, p-value and 95 % interval per term.

        Intervals and p-values are normal-based. The design has a handful of
        terms, so the table is built on the driver.
        """
        terms = [*_term_names(self.design), "Intercept"]
        estimates = [*self.model.coefficients, self.model.intercept]
        rows = []
        for term, estimate, error in zip(terms, estimates, self.standard_errors(), strict=True):
            estimate = float(estimate)
            if error is None or not error > 0:
                rows.append((term, estimate, None, None, None, None, None))
                continue
            z = estimate / error
            rows.append(
                (
                    term, estimate, error, z, math.erfc(abs(z) / math.sqrt(2.0)),
                    estimate - NORMAL_95 * error, estimate + NORMAL_95 * error,
                )
            )
        return self.design.sparkSession.createDataFrame(rows, COEFFICIENT_SCHEMA)


def fit_frequency_glm(modeling: DataFrame) -> FittedGlm:
    """Poisson model of the claim count with log link and log-exposure offset."""
    groups = (
        modeling.where(F.col("Exposure") > 0)
        .groupBy(*FORMULA_FACTORS)
        .agg(
            F.sum("ReportedClaimCount").cast("double").alias("Target"),
            F.log(F.sum("Exposure")).alias("Offset"),
        )
    )
    design = _design(groups)
    model = _learner("poisson").setOffsetCol("Offset").fit(design)
    return FittedGlm(model, design, "Fitted", 1.0)


def fit_severity_glm(modeling: DataFrame) -> FittedGlm:
    """Gamma model of the capped severity with log link; every policy counts once.

    The cap is taken over all policies with claims. Zero severities are dropped
    after it, since the Gamma family has none.
    """
    modeling = cut_lineage(modeling)
    capped = severity_capped(modeling, severity_cap(modeling)).where(F.col("Avg_Severity") > 0)
    severity = F.col("Avg_Severity")
    groups = capped.groupBy(*FORMULA_FACTORS).agg(
        F.avg(severity).alias("Target"),
        F.count("*").cast("double").alias("Policies"),
        F.sum(severity * severity).alias("Squares"),
    )
    design = _design(groups)
    model = _learner("gamma").setWeightCol("Policies").fit(design)
    n, mean, mu = F.col("Policies"), F.col("Target"), F.col("Fitted")
    pearson = (F.col("Squares") - mu * mean * n * 2.0 + n * mu * mu) / (mu * mu)
    totals = (
        model.transform(design).agg(F.sum(pearson).alias("chi2"), F.sum(n).alias("n")).first()
    )
    freedom = totals["n"] - (len(model.coefficients) + 1)
    # As many terms as policies leave nothing to estimate the spread from.
    return FittedGlm(model, design, "Policies", totals["chi2"] / freedom if freedom > 0 else 0.0)


def _design(groups: DataFrame) -> DataFrame:
    """Treatment-coded design; the first area by name is the reference level.

    Rows with an unknown factor take no part in the fit.
    """
    groups = cut_lineage(groups.dropna(subset=list(FORMULA_FACTORS)))
    formula = RFormula(
        formula="Target ~ " + " + ".join(FORMULA_FACTORS),
        stringIndexerOrderType="alphabetDesc",
        labelCol="Label",
    )
    return formula.fit(groups).transform(groups)


def _learner(family: str) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        family=family, link="log", labelCol="Target", featuresCol="features",
        predictionCol="Fitted", maxIter=MAX_ITERATIONS, tol=TOLERANCE,
    )


def _term_names(design: DataFrame) -> list[str]:
    """Names of the design columns, in vector order."""
    kinds = design.schema["features"].metadata["ml_attr"]["attrs"].values()
    found = [(a["idx"], a["name"]) for kind in kinds for a in kind]
    return [name for _, name in sorted(found)]
