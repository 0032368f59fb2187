"""Times the registered queries; prints one JSON line.

Every query is built, run to the end into a no-op sink, and timed as a whole. The session is warmed up with one pass of
the flagship query over the smallest tables, which is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tillflow.plans.catalogue import QUERIES
from tillflow.session import get_spark

HEADLINE = [
    "daily_sales_by_store", "hourly_sales_trend", "top_selling_products", "inventory_snapshot", "low_stock_alerts",
    "order_daily_sales", "order_top_products", "silver_pos_clean", "dedup_latest", "bronze_metadata",
    "contract_pos", "contract_inventory", "contract_ecommerce", "validation_report", "error_breakdown", "quality_gate",
    "ecommerce_funnel", "latency_percentiles", "product_upsert", "reconcile_counts", "file_gate_rows", "schema_drift",
    "stream_decode_split", "stream_dedup", "stream_hourly_sales",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                      spark__ui__showConsoleProgress="false", spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, path: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    names = sys.argv[1:] or HEADLINE
    run("daily_sales_by_store", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    seconds = {name: run(name, sf_dir) for name in names}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
