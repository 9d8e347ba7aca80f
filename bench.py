"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query runs
to the end over all its rows; the stored tables are built inside the timing of
the query that builds them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lossmill.operators import audit, glm, insights, mart  # noqa: E402
from lossmill.plans import catalog  # noqa: E402
from lossmill.plans.warehouse import Warehouse  # noqa: E402
from lossmill.session import local_session, scratch_path  # noqa: E402
from lossmill.sources import orderbook  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = local_session(cores, "lossmill-bench")
    spark.range(1000).groupBy("id").count().count()  # start the executor threads

    def sink(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    store = Warehouse(spark, scratch_path(spark, "bench"), prefix="bench_")
    steps = {
        "policy_portfolio": lambda: sink(orderbook.policy_portfolio(spark, folder)),
        "financial_mart_rowwise": lambda: sink(catalog.financial_mart_rowwise(spark, folder)),
        "monthly_regional_summary": lambda: sink(catalog.monthly_regional_summary(spark, folder)),
        "portfolio_ratios": lambda: sink(catalog.portfolio_ratios(spark, folder)),
        "scan_csv_tolerant": lambda: sink(catalog.scan_csv_tolerant(spark, folder)),
        "warehouse_build": lambda: store.build(orderbook.policy_portfolio(spark, folder)),
        "financial_mart_stored": lambda: sink(
            mart.financial_mart(store.table("policy_portfolio"), store.table("fact_claims"))
        ),
        "monthly_regional_summary_stored": lambda: sink(store.monthly()),
        "modeling_dataset_stored": lambda: sink(store.modeling()),
        "glm_frequency": lambda: glm.fit_frequency_glm(store.modeling()).coefficients().collect(),
        "glm_severity": lambda: glm.fit_severity_glm(store.modeling()).coefficients().collect(),
        "ml_insights": lambda: sink(insights.underwriting_insights(store.modeling())),
        "permutation_importance": lambda: sink(
            audit.importance_summary(audit.permutation_importance(store.audit_data()))
        ),
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
