"""Registered queries: every operator over the order-book tables.

Totals are settled to a fixed number of digits here, since the last bits of a
sum of doubles depend on the row order. The operators themselves return raw sums.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.losses import average_severity
from ..functions.rounding import ratio, settle
from ..operators import audit, glm, insights, mart, modeling, portfolio, reserving, star
from ..operators import boosting as bt
from ..params import NUMERIC_FACTORS, Leakage
from ..session import scratch_path, ship
from ..sources import orderbook, tables
from ..sources.csv import read_csv_auto, read_csv_tolerant
from .warehouse import INSIGHTS, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_REGION, SAMPLE_MONTH = "NATION_7", "1996-01"
AUDIT_LIMITS = Leakage(policies_above=20)

CSV_SCHEMA = T.StructType(
    [
        T.StructField("IDpol", T.LongType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Area", T.StringType()),
    ]
)

_building = threading.RLock()
_stored: dict[tuple[str, str], Warehouse] = {}


# ---- shared frames -------------------------------------------------------


def _portfolio(spark: SparkSession, folder: str) -> DataFrame:
    return orderbook.policy_portfolio(spark, folder)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return mart.policy_ledger(_portfolio(spark, folder))


def _star(spark: SparkSession, folder: str) -> DataFrame:
    """One row per policy with its dimension and fact columns, without a self-join."""
    return star.with_dimension(_ledger(spark, folder))


def _modeling(spark: SparkSession, folder: str) -> DataFrame:
    return modeling.modeling_columns(_ledger(spark, folder))


def _warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The stored tables, built once per session and folder; the joins read these."""
    key = (spark.sparkContext.applicationId, folder)
    with _building:
        if key not in _stored:
            buckets = tables.fitting_buckets(spark, [f"{folder}/{name}.parquet" for name in ("orders", "lineitem")])
            store = Warehouse(spark, scratch_path(spark, "warehouse"), buckets, prefix=f"w{uuid.uuid4().hex}_")
            _stored[key] = store.build(_portfolio(spark, folder))
        return _stored[key]


def _trained_store(spark: SparkSession, folder: str) -> Warehouse:
    """The stored tables with the trees of the three models and their scores, trained once per session and folder."""
    store = _warehouse(spark, folder)
    with _building:
        if not spark.catalog.tableExists(store.name(INSIGHTS)):
            store.train_insights()
    return store


# ---- portfolio and sources -----------------------------------------------


def claims_per_policy(spark: SparkSession, folder: str) -> DataFrame:
    totals = portfolio.claims_per_policy(orderbook.claim_register(spark, folder))
    return totals.withColumn("TotalClaimAmount", settle(F.col("TotalClaimAmount"), 4))


def policy_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    return _portfolio(spark, folder)


def portfolio_validation(spark: SparkSession, folder: str) -> DataFrame:
    return portfolio.portfolio_validation(_portfolio(spark, folder))


def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return portfolio.key_uniqueness(orderbook.exposure_register(spark, folder))


def scan_csv_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as a damaged CSV file, read back tolerantly."""
    key = F.col("o_orderkey")
    number, amount = key.cast("string"), F.col("o_totalprice").cast("string")
    area = F.substring("o_orderpriority", 1, 1)
    line = (
        F.when(key % 7 == 3, F.concat_ws(",", F.lit("abc"), area, number))
        .when(key % 11 == 5, F.concat_ws(",", amount, F.lit(""), F.concat(number, F.lit(".0"))))
        .when(key % 13 == 6, F.concat_ws(",", amount, area, number, F.lit("x"), F.lit("EXTRA")))
        .when(key % 17 == 8, F.concat_ws(",", F.lit(""), area, number))
        .when(key % 19 == 9, F.concat_ws(",", amount, F.concat(F.lit('"'), area, F.lit("\n"), area, F.lit('"')), number))
        .otherwise(F.concat_ws(",", amount, F.concat(F.lit('"'), area, F.lit(',x"')), number, F.lit("more")))
    )
    path = scratch_path(spark, "damaged-csv")
    ship(spark)
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(line.alias("value"))
    orders.mapInArrow(partial(_headed, header="Amount,Area,IDpol,Other"), "value string").write.text(path)
    return read_csv_tolerant(spark, path, CSV_SCHEMA)


def _headed(batches: Iterator[pa.RecordBatch], header: str) -> Iterator[pa.RecordBatch]:
    """The header before the lines of every file."""
    for number, batch in enumerate(batches):
        if not number:
            yield pa.RecordBatch.from_pydict({"value": [header]}, schema=batch.schema)
        yield batch


def scan_csv_auto(spark: SparkSession, folder: str) -> DataFrame:
    """The orders, with a damaged cell here and there, as a file whose separator, header and types have to be found."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    path = scratch_path(spark, "unknown-csv")
    customer = F.when(F.col("o_orderkey") % 997 == 5, "n/a").otherwise(F.col("o_custkey").cast("string"))
    columns = ("o_orderkey", customer.alias("o_custkey"), "o_totalprice", "o_orderpriority")
    orders.select(*columns).write.option("sep", ";").option("header", True).csv(path)
    return read_csv_auto(spark, path)


def mart_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The mart written twice as a bucketed table, then read back."""
    frame = _ledger(spark, folder).select(*mart.MART_COLUMNS)
    path = scratch_path(spark, "mart")
    name = f"mart_{uuid.uuid4().hex}"
    tables.write_table(frame, name, path, bucket_by="IDpol")
    return tables.write_table(frame, name, path, bucket_by="IDpol")


def export_parquet_zstd(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly view exported as ZSTD Parquet, then read back."""
    view = tables.register_view(
        star.monthly_loss_ratios(_star(spark, folder)), "vw_monthly_regional_summary"
    )
    path = tables.export_parquet(view, scratch_path(spark, "monthly"))
    return _settled_months(tables.read_parquet(spark, path))


# ---- reserving and mart --------------------------------------------------


def claim_delays(spark: SparkSession, folder: str) -> DataFrame:
    return reserving.claim_delays(_portfolio(spark, folder))


def claims_reserving(spark: SparkSession, folder: str) -> DataFrame:
    return reserving.claims_reserving(_portfolio(spark, folder))


def reserve_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = reserving.reserve_totals(reserving.claims_reserving(_portfolio(spark, folder)))
    return totals.select(*[settle(F.col(name), 2).alias(name) for name in totals.columns])


def earned_premium(spark: SparkSession, folder: str) -> DataFrame:
    register = orderbook.exposure_register(spark, folder)
    return register.select("IDpol", mart.earned_premium().alias("EarnedPremium"))


def financial_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The join of the stored portfolio with the stored claims table."""
    store = _warehouse(spark, folder)
    return mart.financial_mart(store.table("policy_portfolio"), store.table("fact_claims"))


def financial_mart_rowwise(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder).select(*mart.MART_COLUMNS)


def quota_share(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder).select(
        "IDpol", "ReinsurerCededPremium", "ReinsurerCededLosses", "ReinsuranceCedingCommission"
    )


def portfolio_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return mart.portfolio_ratios(_ledger(spark, folder))


# ---- star schema ---------------------------------------------------------


def dim_policies(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_policies(_portfolio(spark, folder))


def underwriting_date(spark: SparkSession, folder: str) -> DataFrame:
    """Date and cohort month of every policy."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    dated = orders.select(
        F.col("o_orderkey").alias("IDpol"), F.col("o_orderdate").cast("date").alias("Underwriting_Date")
    )
    return dated.withColumn("Underwriting_Month", F.date_format("Underwriting_Date", "yyyy-MM"))


def fact_financials(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_financials(_ledger(spark, folder))


def monthly_regional_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = star.monthly_loss_ratios(_star(spark, folder))
    return _settled_months(tables.register_view(summary, "vw_monthly_regional_summary"))


def monthly_regional_summary_star(spark: SparkSession, folder: str) -> DataFrame:
    """The same view as a join of the stored dimension and fact tables."""
    return _settled_months(_warehouse(spark, folder).monthly())


def _settled_months(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        {
            "Total_EarnedPremium": settle(F.col("Total_EarnedPremium"), 2),
            "Total_UltimateLosses": settle(F.col("Total_UltimateLosses"), 2),
        }
    )


def region_month_sample(spark: SparkSession, folder: str) -> DataFrame:
    summary = star.monthly_loss_ratios(_star(spark, folder))
    return star.region_month_sample(summary, SAMPLE_REGION, SAMPLE_MONTH)


# ---- model datasets ------------------------------------------------------


def modeling_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """The join of the three stored tables."""
    frame = _warehouse(spark, folder).modeling()
    return frame.withColumn("Log_Exposure", settle(F.col("Log_Exposure"), 8))


def modeling_dataset_rowwise(spark: SparkSession, folder: str) -> DataFrame:
    frame = _modeling(spark, folder)
    return frame.withColumn("Log_Exposure", settle(F.col("Log_Exposure"), 8))


def audit_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return _warehouse(spark, folder).audit_data()


def severity_dataset(spark: SparkSession, folder: str) -> DataFrame:
    frame = modeling.severity_dataset(_modeling(spark, folder))
    return frame.select("IDpol", "ReportedClaimCount", "UltimateLosses", "Avg_Severity")


def severity_capped(spark: SparkSession, folder: str) -> DataFrame:
    frame = _warehouse(spark, folder).modeling()
    capped = modeling.severity_capped(frame, modeling.severity_cap(frame))
    return capped.select("IDpol", settle(F.col("Avg_Severity"), 6).alias("Avg_Severity"))


def xol_threshold(spark: SparkSession, folder: str) -> DataFrame:
    threshold = modeling.retention(_warehouse(spark, folder).modeling())
    one_row = spark.range(1)
    return one_row.select(settle(F.lit(threshold).cast("double"), 6).alias("Retention"))


def large_loss_flag(spark: SparkSession, folder: str) -> DataFrame:
    frame = _warehouse(spark, folder).modeling()
    flagged = modeling.with_large_loss_flag(frame, modeling.retention(frame))
    return flagged.select("IDpol", F.col("Is_Large_Loss").cast("bigint").alias("Is_Large_Loss"))


def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    frame = _warehouse(spark, folder).modeling()
    return modeling.class_balance(modeling.with_large_loss_flag(frame, modeling.retention(frame)))


def poisson_deviance(spark: SparkSession, folder: str) -> DataFrame:
    """Deviance of the claim counts against the mean frequency of their region."""
    frame = _modeling(spark, folder)
    count, exposure = F.col("ReportedClaimCount"), F.col("Exposure")
    regions = frame.groupBy("Region").agg((F.sum(count) / F.sum(exposure)).alias("frequency"))
    scored = frame.join(regions, "Region")
    result = modeling.mean_poisson_deviance(scored, "ReportedClaimCount", exposure * F.col("frequency"))
    return result.select(settle(F.col("Mean_Poisson_Deviance"), 8).alias("Mean_Poisson_Deviance"))


# ---- models --------------------------------------------------------------


def _settled_terms(table: DataFrame) -> DataFrame:
    digits = {"Coefficient": 6, "Std_Error": 6, "Z_Value": 3, "P_Value": 6, "Lower_95": 5, "Upper_95": 5}
    return table.select("Term", *[settle(F.col(c), d).alias(c) for c, d in digits.items()])


def glm_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _settled_terms(glm.fit_frequency_glm(_warehouse(spark, folder).modeling()).coefficients())


def glm_severity(spark: SparkSession, folder: str) -> DataFrame:
    return _settled_terms(glm.fit_severity_glm(_warehouse(spark, folder).modeling()).coefficients())


def glm_frequency_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted claims per area; the score equations make them the reported claims."""
    fitted = glm.fit_frequency_glm(_warehouse(spark, folder).modeling()).fitted()
    return fitted.groupBy("Area").agg(settle(F.sum("Fitted"), 2).alias("Claims"))


def glm_frequency_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted claims weighted by each numeric factor; again those of the reported claims."""
    fitted = glm.fit_frequency_glm(_warehouse(spark, folder).modeling()).fitted()
    return fitted.agg(
        *[
            settle(F.sum(F.col("Fitted") * F.col(name)), 0).alias(f"Claims_By_{name}")
            for name in NUMERIC_FACTORS
        ]
    )


def glm_severity_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Observed over fitted severity, summed per area: the number of policies."""
    fitted = glm.fit_severity_glm(_warehouse(spark, folder).modeling()).fitted()
    relative = F.col("Target") / F.col("Fitted") * F.col("Policies")
    return fitted.groupBy("Area").agg(settle(F.sum(relative), 2).alias("Policies"))


def glm_severity_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Observed over fitted severity, weighted by each numeric factor: the sums of the factors."""
    fitted = glm.fit_severity_glm(_warehouse(spark, folder).modeling()).fitted()
    relative = F.col("Target") / F.col("Fitted") * F.col("Policies")
    return fitted.agg(*[settle(F.sum(relative * F.col(name)), 0).alias(f"Sum_{name}") for name in NUMERIC_FACTORS])


def boosted_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return ml_insights(spark, folder).select("IDpol", "Pred_Frequency_Count")


def boosted_severity(spark: SparkSession, folder: str) -> DataFrame:
    return ml_insights(spark, folder).select("IDpol", "Pred_Severity_Cost")


def xol_probability(spark: SparkSession, folder: str) -> DataFrame:
    return ml_insights(spark, folder).select("IDpol", "XoL_Trigger_Probability", "Is_Large_Loss")


def ml_insights(spark: SparkSession, folder: str) -> DataFrame:
    """The stored insights table."""
    frame = _trained_store(spark, folder).table(INSIGHTS)
    return frame.withColumn("Is_Large_Loss", F.col("Is_Large_Loss").cast("bigint"))


def renewal_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Next year's portfolio scored from the stored trees: every car and driver a year older, every policy for a full year."""
    renewed = _portfolio(spark, folder).select(
        "IDpol", F.lit(1.0).alias("Exposure"), "Area", "Region", "VehPower", "BonusMalus",
        (F.col("VehAge") + 1).alias("VehAge"), (F.col("DrivAge") + 1).alias("DrivAge"),
    )
    scored = _trained_store(spark, folder).score(renewed)
    return scored.select("IDpol", "Pred_Frequency_Count", "Pred_Severity_Cost", "XoL_Trigger_Probability")


def pure_premium(spark: SparkSession, folder: str) -> DataFrame:
    return ml_insights(spark, folder).select(
        "IDpol", "Pred_Frequency_Count", "Pred_Severity_Cost", "Expected_Pure_Premium",
        "Technical_Loss_Ratio",
    )


def pure_premium_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Pure premium with the observed count and severity in place of predictions."""
    frame = _modeling(spark, folder)
    observed = frame.withColumns(
        {
            "Pred_Frequency_Count": F.col("ReportedClaimCount").cast("double"),
            "Pred_Severity_Cost": F.coalesce(
                average_severity(F.col("UltimateLosses"), F.col("ReportedClaimCount")), F.lit(0.0)
            ),
        }
    )
    return insights.pure_premium(observed).select(
        "IDpol", "Expected_Pure_Premium", "Technical_Loss_Ratio"
    )


def insight_validation(spark: SparkSession, folder: str) -> DataFrame:
    return insights.insight_validation(ml_insights(spark, folder))


# ---- audit ---------------------------------------------------------------


def _observed_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Actual losses and their ratio to premium in place of model scores."""
    frame = _ledger(spark, folder).where(F.col("Exposure") > 0)
    return frame.select(
        "IDpol",
        F.col("TotalClaimAmount").alias("Expected_Pure_Premium"),
        (ratio(F.col("TotalClaimAmount"), F.col("EarnedPremium")) * 100.0).alias(
            "Technical_Loss_Ratio"
        ),
    )


def leakage_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return audit.leakage_clusters(
        _observed_insights(spark, folder),
        _warehouse(spark, folder).table("dim_policies"),
        AUDIT_LIMITS,
    )


def leakage_clusters_model(spark: SparkSession, folder: str) -> DataFrame:
    return audit.leakage_clusters(
        ml_insights(spark, folder), _warehouse(spark, folder).table("dim_policies"), AUDIT_LIMITS
    )


def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Distribution of the permutation importance per factor."""
    importances = audit.permutation_importance(_warehouse(spark, folder).audit_data())
    return audit.importance_summary(importances)


def permutation_importance_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The same audit of a plain model of relative means, whose every step SQL can repeat."""
    data = _warehouse(spark, folder).audit_data()
    summary = audit.importance_summary(audit.importance_of(audit.marginal_rates(data), data))
    return summary.select("Feature", *[settle(F.col(c), 8).alias(c) for c in summary.columns[1:]])


def permutation_donors(spark: SparkSession, folder: str) -> DataFrame:
    """Claims, own and donors' regions of every policy, in all repeats."""
    data = _warehouse(spark, folder).audit_data().select("IDpol", *bt.filled_factors(), "ReportedClaimCount")
    donors = audit.with_donors(data, audit.REPEATS, audit.SEED)
    regions = [F.col(f"c{r}.Region").alias(f"Region_{r}") for r in range(audit.REPEATS + 1)]
    return donors.select("IDpol", "claims", *regions)


QUERIES: tuple[Query, ...] = (
    claims_per_policy, policy_portfolio, portfolio_validation, key_uniqueness,
    scan_csv_tolerant, scan_csv_auto, mart_roundtrip, export_parquet_zstd,
    claim_delays, claims_reserving, reserve_totals,
    earned_premium, financial_mart, financial_mart_rowwise, quota_share, portfolio_ratios,
    dim_policies, underwriting_date, fact_financials,
    monthly_regional_summary, monthly_regional_summary_star, region_month_sample,
    modeling_dataset, modeling_dataset_rowwise, audit_dataset,
    severity_dataset, severity_capped, xol_threshold, large_loss_flag, class_balance,
    poisson_deviance,
    glm_frequency, glm_severity, glm_frequency_balance,
    glm_frequency_moments, glm_severity_balance, glm_severity_moments,
    boosted_frequency, boosted_severity, xol_probability,
    pure_premium, pure_premium_observed, ml_insights, renewal_scores, insight_validation,
    leakage_clusters, leakage_clusters_model, permutation_importance, permutation_importance_rates, permutation_donors,
)


def registered() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}
