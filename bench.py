"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aeroledger.plans import registry  # noqa: E402
from aeroledger.session import build_session  # noqa: E402

HEADLINE = [
    "rotation_delay", "mart_rotation_delay", "load_factor", "delay_minutes", "cancellation_rate", "baggage_sla_daily",
    "route_revenue", "revenue_per_flight", "complaint_rate", "validate_rejects", "bronze_to_silver", "upsert_orders",
    "dq_suite", "dup_keys", "profile_all_columns", "route_profitability", "bag_cycle_sla", "route_demand_daily",
    "cancellation_anomalies", "forecast_features", "delay_actions", "demand_alerts", "quantile", "stream_latest_state",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry.run("delay_minutes", spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
