"""Wall seconds of the headline queries; prints one JSON line.

Each query is built and fully computed (written to a sink that discards rows).
One small query warms the session up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderwell.session import build_session  # noqa: E402
from oracle import load_all  # noqa: E402

HEADLINE = (
    "m01_order_lines",
    "m02_order_summary",
    "m03_customer_metrics",
    "m05_monthly_performance",
    "m06_cohort_retention",
    "m07_product_performance",
    "m10_campaign_performance",
    "m11_sales_performance",
    "m13a_rfm_snapshot",
    "m14_product_affinity",
    "m21_repeat_timing",
    "m22_churn_risk",
    "m23_value_tiers",
    "m26_product_portfolio",
    "m28_delivery_risk",
    "m31_discount_effectiveness",
    "m32_regional_contribution",
    "m34_pareto_curve",
    "m35_acquisition_performance",
    "m40_executive_scorecard",
    "q05_payment_reconciliation",
    "q11_grain_reconciliation",
    "x03_orders_customers",
    "x13_revenue_series",
)


def run(spark, query, folder: str) -> float:
    start = time.time()
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = load_all()
    run(spark, queries["m05_monthly_performance"], folder)
    seconds = {name: round(run(spark, queries[name], folder), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
