"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver).  Reported time per query is the warm run
(a first run warms the JVM and file listing caches); ``cold`` holds the
first-run times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "customer_health", "ticket_kpis", "incident_kpis", "operations_view", "sla_view", "ticket_extract",
    "incident_extract", "executive_summary", "penalty_exposure", "capacity_hourly", "capacity_by_region",
    "sla_config_minutes", "sla_contract_terms", "region_rollup", "insights", "incident_region_detail",
    "mttr_box_stats", "reassign_impact", "corr_incidents", "day_hour_heatmap", "load_fact_ticket",
    "load_fact_incident", "load_fact_metrics", "profile_describe", "validation_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from deskflow.queries import REGISTRY
    from deskflow.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 4, app="deskflow-bench")
    warm, cold = {}, {}
    for name in names:
        for target in (cold, warm):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            target[name] = round(time.perf_counter() - t0, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
