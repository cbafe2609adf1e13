"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local threads.
Each query is written to the ``noop`` sink, so all rows and columns are computed
and none travel to the driver. One untimed pass over the smallest headline query
starts the JVM's workers first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyhouse.queries import QUERIES  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402

HEADLINE = [
    "product_history", "population2", "population_multi", "population_from_payloads",
    "customer_order_behavior", "customer_preferences", "customer_order_summaries",
    "customer_profile", "vip_points", "loyalty_benchmarks", "customer_segments",
    "last_touch_join", "sms_attribution_lines", "campaign_roi", "optin_status",
    "staff_kpis", "ticket_roi", "stock_by_sku", "append_new_lines", "days_since_previous_order",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["product_history"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
