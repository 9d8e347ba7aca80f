"""Underwriting insights: expected cost, technical loss ratio, trigger chance."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import ratio
from ..params import Leakage
from ..session import cut_lineage
from . import boosting as bt
from .modeling import retention, with_large_loss_flag

INSIGHT_COLUMNS = (
    "IDpol", "Pred_Frequency_Count", "Pred_Severity_Cost", "Expected_Pure_Premium",
    "Technical_Loss_Ratio", "XoL_Trigger_Probability", "Is_Large_Loss",
)


#: The three models, and what their margins are called.
MODELS = ("frequency", "severity", "trigger")


@dataclass
class RatingCells:
    """Policies with their large-loss flag, and the sums per rating cell."""

    policies: DataFrame
    cells: DataFrame
    threshold: float | None


def rating_cells(modeling: DataFrame) -> RatingCells:
    """Prepare the three models in one go.

    Both frames are written to the shared folder: the policies are read for the
    retention, the cells and the final scores, the cells in every training job. The
    grouping sums before its shuffle, so a cell that holds a large part of the
    portfolio costs one row per task.
    """
    modeling = cut_lineage(modeling)
    threshold = retention(modeling)
    flagged = with_large_loss_flag(modeling, threshold)
    severity_known = (F.col("ReportedClaimCount") > 0) & (F.col("UltimateLosses") > 0)
    severity = F.col("UltimateLosses") / F.nullif(F.col("ReportedClaimCount"), F.lit(0))
    cells = flagged.groupBy(*bt.filled_factors()).agg(
        F.sum("Exposure").alias("exposure"),
        F.sum("ReportedClaimCount").cast("double").alias("claims"),
        F.count_if(severity_known).cast("double").alias("severities"),
        F.coalesce(F.sum(F.when(severity_known, severity)), F.lit(0.0)).alias("severity"),
        F.count("*").cast("double").alias("policies"),
        F.sum("Is_Large_Loss").cast("double").alias("large"),
    )
    return RatingCells(flagged, cut_lineage(cells), threshold)


def fit_frequency(cells: DataFrame, params: bt.Boosting = bt.FREQUENCY, **state) -> bt.BoostedTrees:
    """Claim count with the log-exposure offset."""
    return bt.boost(cells, bt.poisson(), params, "claims", "exposure", **state)


def fit_severity(cells: DataFrame, params: bt.Boosting = bt.SEVERITY, **state) -> bt.BoostedTrees:
    """Loss per claim, fitted where it is known."""
    totals = cells.agg(F.sum("severity").alias("s"), F.sum("severities").alias("n")).first()
    base = math.log(totals["s"] / totals["n"]) if totals["n"] else 0.0
    return bt.boost(cells, bt.gamma(base), params, "severity", "severities", **state)


def fit_trigger(cells: DataFrame, params: bt.Boosting = bt.TRIGGER, **state) -> bt.BoostedTrees:
    """Chance of a large loss; positives weigh as much in total as negatives."""
    totals = cells.agg(F.sum("policies").alias("n"), F.sum("large").alias("p")).first()
    weight = (totals["n"] - totals["p"]) / totals["p"] if totals["p"] else 1.0
    weighted = cells.withColumns(
        {
            "large_weight": F.col("large") * weight,
            "total_weight": F.col("large") * weight + (F.col("policies") - F.col("large")),
        }
    )
    sums = weighted.agg(F.sum("large_weight").alias("p"), F.sum("total_weight").alias("n")).first()
    # Balanced weights put the starting chance at one half.
    share = sums["p"] / sums["n"] if sums["n"] else 0.5
    base = math.log(share / (1.0 - share)) if 0.0 < share < 1.0 else 0.0
    return bt.boost(weighted, bt.logistic(base), params, "large_weight", "total_weight", **state)


def train_models(
    cells: DataFrame,
    frequency: bt.Boosting = bt.FREQUENCY,
    severity: bt.Boosting = bt.SEVERITY,
    trigger: bt.Boosting = bt.TRIGGER,
    saved: dict[str, bt.BoostedTrees] | None = None,
    save: Callable[[str, DataFrame], object] = lambda name, rows: None,
) -> dict[str, bt.BoostedTrees]:
    """Fit the three models side by side.

    The models do not depend on each other, so the jobs of one fill the cluster
    while another one waits for its last tasks. `saved` holds models of earlier
    rounds; every job's rows go to `save` with the model's name.
    """
    fits = {"frequency": (fit_frequency, frequency), "severity": (fit_severity, severity), "trigger": (fit_trigger, trigger)}
    # The models differ in their sums, not in the values of the factors.
    grids = {bins: bt.fitted_grid(cells, params) for bins, params in {p.bins: p for _, p in fits.values()}.items()}
    bind, saves = inheritable_thread_target(cells.sparkSession), []
    # A model's next rounds do not wait for its last ones to be written.
    with ThreadPoolExecutor(len(fits)) as pool, ThreadPoolExecutor(1) as writer:

        def save_later(name: str, rows: DataFrame) -> None:
            saves.append(writer.submit(bind(partial(save, name, rows))))

        calls = [
            partial(fit, cells, params, saved=(saved or {}).get(name), save=partial(save_later, name), grid=grids[params.bins])
            for name, (fit, params) in fits.items()
        ]
        trained = dict(zip(fits, pool.map(lambda fit: fit(), map(bind, calls))))
        for done in saves:
            done.result()
        return trained


def frequency_count() -> Column:
    """Expected claims over the policy's own exposure, not per year."""
    return F.col("Exposure") * F.exp("frequency_margin")


def severity_cost() -> Column:
    return F.exp("severity_margin")


def trigger_probability() -> Column:
    return bt.probability(F.col("trigger_margin"))


def score_policies(policies: DataFrame, models: dict[str, bt.BoostedTrees]) -> DataFrame:
    """Margins of any policies with rating factors, trained on or not; nothing is shuffled."""
    return bt.margins(policies, {f"{name}_margin": models[name] for name in MODELS})


def with_predictions(scored: DataFrame) -> DataFrame:
    """Turn the three margins into a count, a cost and a probability."""
    return scored.withColumns(
        {
            "Pred_Frequency_Count": frequency_count(),
            "Pred_Severity_Cost": severity_cost(),
            "XoL_Trigger_Probability": trigger_probability(),
        }
    )


def pure_premium(scored: DataFrame) -> DataFrame:
    """Expected loss per policy and its ratio to the premium charged, in percent.

    ``scored`` has predicted frequency, predicted severity and the premium.
    """
    return scored.withColumn(
        "Expected_Pure_Premium", F.col("Pred_Frequency_Count") * F.col("Pred_Severity_Cost")
    ).withColumn(
        "Technical_Loss_Ratio",
        ratio(F.col("Expected_Pure_Premium"), F.col("EarnedPremium")) * 100.0,
    )


def underwriting_insights(
    modeling: DataFrame,
    frequency: bt.Boosting = bt.FREQUENCY,
    severity: bt.Boosting = bt.SEVERITY,
    trigger: bt.Boosting = bt.TRIGGER,
) -> DataFrame:
    """Train the three models and return one insight row per policy.

    Training and scoring use the same policies; there is no holdout.
    """
    prepared = rating_cells(modeling)
    return insights_of(prepared.policies, train_models(prepared.cells, frequency, severity, trigger))


def insights_of(policies: DataFrame, models: dict[str, bt.BoostedTrees]) -> DataFrame:
    """Insight rows of policies with exposure, premium and large-loss flag."""
    scored = with_predictions(score_policies(policies, models))
    return pure_premium(scored).select(*INSIGHT_COLUMNS)


def insight_validation(insights: DataFrame, limits: Leakage = Leakage()) -> DataFrame:
    """Mean technical loss ratio and the number of policies above the limit."""
    ratio_ = F.col("Technical_Loss_Ratio")
    return insights.agg(
        F.avg(ratio_).alias("Avg_Technical_LR"),
        F.count_if(ratio_ > limits.ratio_above).alias("High_Risk_Policies"),
    )
