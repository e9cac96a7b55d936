"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from retailspark.plans.catalog import QUERIES
from retailspark.session import local_session

HEADLINE = [
    "rpt_top_products",
    "rpt_top_products_full",
    "rpt_top_customers",
    "rpt_top_customers_full",
    "rpt_store_revenue",
    "rpt_store_revenue_linegrain",
    "rpt_category",
    "rpt_category_full",
    "rpt_brand",
    "rpt_brand_full",
    "rpt_monthly",
    "rpt_monthly_linegrain",
    "rpt_low_stock",
    "rpt_low_stock_detail",
    "rpt_store_inventory",
    "rpt_store_inventory_full",
    "rpt_staff",
    "rpt_staff_full",
    "rpt_best_staff",
    "rpt_best_staff_linegrain",
    "rpt_customer_spending",
    "rpt_customer_spending_full",
    "rpt_customers_no_orders",
    "rpt_retention",
    "rpt_status",
    "rpt_status_full",
    "rpt_kpis",
    "dq_findings",
    "dq_describe",
    "dq_orphans",
    "cln_orders",
    "cln_order_items",
    "cln_quarantine",
    "enr_order_total",
    "load_fk_violations",
    "job_stage_log",
]


def run(spark, name: str, folder: str) -> float:
    """Seconds to plan the query and compute every row and column of its result."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus))
    run(spark, "rpt_status_full", folder)  # starts the JVM's caches and compiler
    seconds = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
