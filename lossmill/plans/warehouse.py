"""The stored star schema, from the registers to the exports.

Each step writes one table and the next step reads it. All tables are bucketed
by the policy key with one bucket count, so neither the joins between them nor
the writes after the first need a shuffle. A build that failed can be resumed: it
keeps the tables that are there and goes on with the first that is not.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, insights, mart, modeling, reserving, star
from ..operators import boosting as bt
from ..params import Calendar, Expenses, Leakage, QuotaShare, Reserving, Tariff
from ..sources.tables import export_parquet, register_view, write_table

KEY = "IDpol"
MONTHLY_VIEW = "vw_monthly_regional_summary"
INSIGHTS = "ml_underwriting_insights"
MODEL_NODES = "model_nodes"

_appending = threading.Lock()  # the three models train side by side


@dataclass(frozen=True)
class Settings:
    """Business parameters of one build."""

    reserving: Reserving = field(default_factory=Reserving)
    tariff: Tariff = field(default_factory=Tariff)
    expenses: Expenses = field(default_factory=Expenses)
    treaty: QuotaShare = field(default_factory=QuotaShare)
    calendar: Calendar = field(default_factory=Calendar)
    ibnr_additive: bool = True


@dataclass
class Warehouse:
    """Names and location of the stored tables, in the current database or the one given."""

    spark: SparkSession
    folder: str
    buckets: int | None = None
    prefix: str = ""
    database: str | None = None

    def name(self, name: str) -> str:
        return f"{self.database}.{self.prefix}{name}" if self.database else self.prefix + name

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.name(name))

    def store(self, frame: DataFrame, name: str, aligned: bool = False, resume: bool = False) -> DataFrame:
        """Write a table; with `resume` only if it is not there."""
        if resume and self.spark.catalog.tableExists(self.name(name)):
            return self.table(name)
        return write_table(
            frame,
            self.name(name),
            f"{self.folder}/{name}",
            bucket_by=KEY,
            buckets=self.buckets,
            aligned=aligned,
        )

    def build(
        self, portfolio: DataFrame, settings: Settings = Settings(), resume: bool = False
    ) -> Warehouse:
        """Write portfolio, claims, mart and dimension, and name the monthly view.

        The financial fact is the mart under another name, so it is not copied.
        Running it again replaces the tables, unless it resumes a failed build.
        """
        s = settings
        portfolio = self.store(portfolio, "policy_portfolio", resume=resume)
        claims = reserving.claims_reserving(portfolio, s.reserving)
        claims = self.store(claims, "fact_claims", aligned=True, resume=resume)
        marts = mart.financial_mart(
            portfolio, claims, s.tariff, s.expenses, s.treaty, s.ibnr_additive
        )
        self.store(marts, "financial_reporting_mart", aligned=True, resume=resume)
        dimension = star.dim_policies(portfolio, s.calendar)
        self.store(dimension, "dim_policies", aligned=True, resume=resume)
        register_view(self.monthly(), self.prefix + MONTHLY_VIEW)
        return self

    def fact(self) -> DataFrame:
        return star.fact_financials(self.table("financial_reporting_mart"))

    def monthly(self) -> DataFrame:
        return star.monthly_regional_summary(self.table("dim_policies"), self.fact())

    def modeling(self) -> DataFrame:
        return modeling.modeling_dataset(
            self.table("dim_policies"), self.fact(), self.table("policy_portfolio")
        )

    def audit_data(self) -> DataFrame:
        return modeling.audit_dataset(self.table("dim_policies"), self.table("policy_portfolio"))

    def export(self, folder: str) -> list[str]:
        """Dimension, fact and monthly view as ZSTD Parquet for reporting tools."""
        return [
            export_parquet(self.table("dim_policies"), f"{folder}/dim_policies.parquet"),
            export_parquet(self.fact(), f"{folder}/fact_financials.parquet"),
            export_parquet(self.monthly(), f"{folder}/vw_monthly_summary.parquet"),
        ]

    def models(self) -> dict[str, bt.BoostedTrees]:
        """The stored models, as far as they have been trained."""
        if not self.spark.catalog.tableExists(self.name(MODEL_NODES)):
            return {}
        # A few hundred nodes for each round of a model.
        rows: dict[str, list[tuple]] = {}
        for name, *row in self.table(MODEL_NODES).collect():
            rows.setdefault(name, []).append(tuple(row))
        return {name: bt.BoostedTrees(found) for name, found in rows.items()}

    def _save_nodes(self, model: str, rows: DataFrame) -> None:
        named = rows.select(F.lit(model).alias("model"), *rows.columns).coalesce(1)
        with _appending:
            named.write.mode("append").option("path", f"{self.folder}/{MODEL_NODES}").saveAsTable(self.name(MODEL_NODES))

    def train_insights(
        self,
        frequency: bt.Boosting = bt.FREQUENCY,
        severity: bt.Boosting = bt.SEVERITY,
        trigger: bt.Boosting = bt.TRIGGER,
        resume: bool = False,
    ) -> DataFrame:
        """Train the three models, store their trees and the scores per policy.

        With `resume` a training goes on from the rounds that are stored, otherwise
        it begins anew.
        """
        if not resume:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(MODEL_NODES)}")
            empty = self.spark.createDataFrame([], f"model string, {bt.NODES}")
            empty.write.mode("overwrite").option("path", f"{self.folder}/{MODEL_NODES}").saveAsTable(self.name(MODEL_NODES))
        prepared = insights.rating_cells(self.modeling())
        trained = insights.train_models(
            prepared.cells, frequency, severity, trigger, saved=self.models(), save=self._save_nodes
        )
        return self.store(insights.insights_of(prepared.policies, trained), INSIGHTS)

    def score(self, policies: DataFrame) -> DataFrame:
        """Predictions of the stored models for any policies with exposure and rating factors."""
        return insights.with_predictions(insights.score_policies(policies, self.models()))

    def leakage(self, limits: Leakage = Leakage()) -> DataFrame:
        return audit.leakage_clusters(
            self.table(INSIGHTS), self.table("dim_policies"), limits
        )
