"""Time the headline queries; prints one JSON line.

Tables a deployment would have stored (points, deltas, incident log) are built
by the first query that needs them; ``monitoring_tables`` times exactly that.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewatch.plans.queries import REGISTRY  # noqa: E402
from tidewatch.plans.workload import Monitoring  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "actuals_daily_by_dim", "actuals_hourly_total", "actuals_shared_scan", "actuals_delta_load", "scd2_upsert",
    "forecast_mean", "forecast_median", "forecast_all_methods", "forecast_mstl", "deltas_classified",
    "monitoring_tables", "deltas_keys_of_interest", "incident_transitions", "actions_by_mode", "incidents_after_run",
    "outbox_messages", "publication_lags", "environment_comparison", "dedup_new_hashes", "severity_ribbon_14d",
]


def monitoring_tables(spark, folder):
    Monitoring._known.clear()
    tables = Monitoring.of(spark, folder)
    tables.events()
    return tables.deltas()


def main() -> None:
    spark = build_session("tidewatch-bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
                          spark__ui__enabled="false", spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["actuals_daily_by_dim"](spark, FOLDER).collect()  # start-up is not measured
    seconds = {}
    for name in HEADLINES:
        run = REGISTRY.get(name, monitoring_tables)
        started = time.perf_counter()
        run(spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "headline_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
