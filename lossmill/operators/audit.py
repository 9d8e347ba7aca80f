"""Underwriting audit: leakage clusters and permutation importance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import round_away, settle
from ..params import RATING_FACTORS, Leakage
from ..session import cut_lineage, ship
from . import boosting as bt

REPEATS = 5
SEED = 42
#: Policies among which donors are exchanged.
BLOCK_ROWS = 10_000


def leakage_clusters(
    insights: DataFrame, dimension: DataFrame, limits: Leakage = Leakage()
) -> DataFrame:
    """Segments of region and vehicle power with the worst technical loss ratios.

    ``insights`` is any frame with a technical loss ratio and an expected loss
    per policy. Ties in the mean are ordered by segment.
    """
    toxic = insights.where(F.col("Technical_Loss_Ratio") > limits.ratio_above).select(
        "IDpol", "Technical_Loss_Ratio", "Expected_Pure_Premium"
    )
    return (
        toxic.join(dimension.select("IDpol", "Region", "VehPower"), "IDpol")
        .groupBy("Region", "VehPower")
        .agg(
            round_away(settle(F.avg("Technical_Loss_Ratio"), 6), 2).alias("Avg_TLR"),
            F.count("*").alias("Toxic_Policy_Count"),
            round_away(settle(F.sum("Expected_Pure_Premium"), 4), 2).alias("Total_Expected_Losses"),
        )
        .where(F.col("Toxic_Policy_Count") > limits.policies_above)
        .orderBy(F.desc_nulls_last("Avg_TLR"), "Region", "VehPower")
        .limit(limits.top)
    )


def fit_audit_model(audit: DataFrame, params: bt.Boosting) -> bt.BoostedTrees:
    """Claim-count model without offset, for the audit only; margins start at the mean."""
    cells = cut_lineage(
        audit.groupBy(*bt.filled_factors()).agg(
            F.sum("ReportedClaimCount").cast("double").alias("claims"),
            F.count("*").cast("double").alias("policies"),
        )
    )
    totals = cells.agg(F.sum("claims").alias("y"), F.sum("policies").alias("n")).first()
    mean = totals["y"] / totals["n"] if totals["n"] else 0.0
    base = math.log(mean) if mean > 0 else 0.0
    return bt.boost(cells, bt.poisson(base), params, "claims", "policies")


def marginal_rates(audit: DataFrame, power_above: int = 9) -> bt.BoostedTrees:
    """A plain rating model in the form of trees: the mean count, times the relative means of area, region and strong cars.

    It needs no training and its margins can be written down in one line, which makes
    an audit on it easy to follow.
    """
    count = F.avg("ReportedClaimCount").alias("y")
    mean = audit.agg(count).first()["y"] or 1.0

    def step(y: float | None) -> float:
        return math.log(y / mean) if y else 0.0

    rows: list[tuple] = [(0, 1, None, None, None, math.log(mean))]
    for name in ("Area", "Region"):
        # One row per category.
        for level, y in audit.groupBy(F.coalesce(F.col(name), F.lit(bt.MISSING_CATEGORY)).alias("level")).agg(count).collect():
            turn = rows[-1][0] + 1
            rows += [(turn, 1, name, None, [level], None), (turn, 2, None, None, None, step(y)), (turn, 3, None, None, None, 0.0)]
    strong = dict(audit.groupBy((F.coalesce("VehPower", F.lit(-1)) > power_above).alias("strong")).agg(count).collect())
    turn = rows[-1][0] + 1
    rows += [(turn, 1, "VehPower", float(power_above), None, None)]
    rows += [(turn, 2, None, None, None, step(strong.get(False))), (turn, 3, None, None, None, step(strong.get(True)))]
    return bt.BoostedTrees(rows)


def permutation_importance(
    audit: DataFrame, params: bt.Boosting = bt.AUDIT, repeats: int = REPEATS, seed: int = SEED
) -> DataFrame:
    """Loss of fit when one factor is shuffled over the policies, per repeat.

    The importance is the rise of the mean Poisson deviance. The policies are put in
    an order by the hash of their key and values; a repeat gives each policy the
    factor of one that stands a random distance behind it (`with_donors`). Every
    value is used exactly once, and neither the order nor the distances depend on
    how the rows are stored. A repeat serves all factors.
    """
    audit = cut_lineage(audit)
    return importance_of(fit_audit_model(audit, params), audit, repeats, seed)


def importance_of(model: bt.BoostedTrees, audit: DataFrame, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """The same for a model that is there already."""
    ship(audit.sparkSession)
    labels = [(name, repeat) for name in RATING_FACTORS for repeat in range(1, repeats + 1)]
    schema = ", ".join(f"fit{i} double" for i in range(len(labels) + 1)) + ", n long"
    shuffled = with_donors(audit.select("IDpol", *bt.filled_factors(), "ReportedClaimCount"), repeats, seed)
    totals = shuffled.mapInArrow(partial(_fits, model=model, repeats=repeats), schema)
    totals = totals.agg(*[F.sum(c).alias(c) for c in totals.columns])
    intact = F.col(f"fit{len(labels)}")
    rows = [
        F.struct(
            F.lit(name).alias("Feature"),
            F.lit(repeat).cast("bigint").alias("Repeat"),
            # Terms of the deviance without model output cancel in the difference.
            ((F.col(f"fit{i}") - intact) * 2.0 / F.col("n")).alias("Importance"),
        )
        for i, (name, repeat) in enumerate(labels)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _fits(batches: Iterator[pa.RecordBatch], model: bt.BoostedTrees, repeats: int) -> Iterator[pa.RecordBatch]:
    """Per batch the fit of each factor and repeat, the factor's values taken from the donor, and that of nothing shuffled."""
    for batch in batches:
        claims = batch["claims"].to_numpy(zero_copy_only=False).astype(np.float64)
        codes = [model.codes([batch[f"c{r}"].field(name) for name in RATING_FACTORS]) for r in range(repeats + 1)]

        def fit(margin: np.ndarray, claims=claims) -> float:
            return float((np.exp(margin) - claims * margin).sum())

        # By factor and repeat, as in the labels.
        sums = [fit(margin) for _, _, margin in model.exchanged(codes)]
        sums.append(fit(model.margins(codes[0])))
        yield pa.RecordBatch.from_pydict({f"fit{i}": [x] for i, x in enumerate(sums)} | {"n": [len(claims)]})


def donor_order(seed: int) -> Column:
    """Random order of the policies that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("IDpol").cast("string"), F.lit(""))))


def draws(repeats: int, seed: int) -> list[float]:
    """How far behind a donor stands, as a share of its block, for each repeat."""
    return np.random.default_rng(seed).random(repeats).tolist()


def with_donors(audit: DataFrame, repeats: int, seed: int) -> DataFrame:
    """One row per policy: key, claims, its own factors c0 and those of a donor per repeat, c1 and on.

    The digits of the order deal the policies out to blocks of about `BLOCK_ROWS`,
    each a random part of the portfolio; in its block, taken in order, a policy gets
    the factors of the one that stands the drawn distance behind it, the first ones
    those of the last. So every policy is a donor once per repeat, and one exchange
    of the table serves all repeats.
    """
    blocks = max(1, audit.count() // BLOCK_ROWS)
    order = donor_order(seed).alias("order")
    rows = audit.select(order, "IDpol", F.struct(*RATING_FACTORS).alias("c0"), F.col("ReportedClaimCount").alias("claims"))
    block = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % blocks
    rows = rows.withColumn("block", block).repartition("block")
    # Rows that are equal in all of this are interchangeable.
    rows = rows.sortWithinPartitions("block", "order", "IDpol", "c0", "claims")
    kept = [rows.schema["IDpol"], rows.schema["claims"]]
    factors = [T.StructField(f"c{r}", rows.schema["c0"].dataType) for r in range(repeats + 1)]
    return rows.mapInArrow(partial(_shifted, shares=draws(repeats, seed)), T.StructType([*kept, *factors]))


def _shifted(batches: Iterator[pa.RecordBatch], shares: list[float]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def block() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        place, own = np.arange(rows.num_rows), rows["c0"].combine_chunks()
        shifts = [1 + int(x * (len(place) - 1)) for x in shares]
        taken = [own.take(pa.array((place - shift) % len(place))) for shift in shifts]
        columns = [rows["IDpol"], rows["claims"], own, *taken]
        names = ["IDpol", "claims", *(f"c{r}" for r in range(len(shares) + 1))]
        yield from pa.table(columns, names).to_batches(max_chunksize=10_000)

    for batch in batches:
        number = batch["block"].to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        for first, last in zip(bounds, bounds[1:]):
            if held and last > first and held[-1]["block"][0].as_py() != number[first]:
                yield from block()
                held = []
            if last > first:
                held.append(batch.slice(first, last - first))
    if held:
        yield from block()


def importance_summary(importances: DataFrame) -> DataFrame:
    """Distribution of the importance per factor, least important first.

    A factor has one row per repeat, so the percentiles work on a handful.
    """
    value = F.col("Importance")
    quartiles = F.percentile(value, [0.25, 0.5, 0.75])
    return (
        importances.groupBy("Feature")
        .agg(
            F.avg(value).alias("Mean_Importance"),
            F.stddev_pop(value).alias("Std_Importance"),
            F.min(value).alias("Min_Importance"),
            quartiles.alias("quartiles"),
            F.max(value).alias("Max_Importance"),
        )
        .select(
            "Feature", "Mean_Importance", "Std_Importance", "Min_Importance",
            F.col("quartiles")[0].alias("Q1_Importance"),
            F.col("quartiles")[1].alias("Median_Importance"),
            F.col("quartiles")[2].alias("Q3_Importance"),
            "Max_Importance",
        )
        .orderBy(F.asc_nulls_last("Mean_Importance"), "Feature")
    )
