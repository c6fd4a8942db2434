"""Time the headline queries. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). The star schema is
loaded first and timed as ``load``, then the customer scores as ``rfm``; the reports then read the stored
tables, as they would in use.
"""

from __future__ import annotations

import json
import os
import time

from basketry.plans import catalog
from basketry.session import build_session

HEADLINE = [
    "rfm_segment",
    "kpi_overview",
    "sales_by_region",
    "sales_by_sector",
    "monthly_sales",
    "top_products_revenue",
    "top_brands",
    "promo_revenue",
    "delivery_delay_stats",
    "payment_by_method",
    "sales_growth",
    "retention_new_returning",
    "customer_payment_balance",
    "describe_numeric",
    "fk_subset",
    "dedup_keep_first",
    "ri_map_unknown",
    "clean_sales_line",
    "pareto_80",
    "boxplot_stats",
    "region_segment_pivot",
    "clv_summary_table",
    "churn_features",
    "pair_rules",
    "frequent_itemsets",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
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
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    start = time.perf_counter()
    catalog.QUERIES["star_build"](spark, folder).collect()
    seconds["load"] = round(time.perf_counter() - start, 3)
    # Builds and stores the scores that the reports on customers read.
    start = time.perf_counter()
    catalog.QUERIES["segment_counts"](spark, folder).collect()
    seconds["rfm"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
