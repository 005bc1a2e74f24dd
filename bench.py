"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of cores, BENCH_RUNS the timed runs after one warm-up run,
BENCH_QUERIES (comma separated) limits the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caselight.bindings import catalog  # noqa: E402
from caselight.session import build_session  # noqa: E402

HEADLINE = [
    "mart_serious_events", "mart_drug_reactions", "top_drugs", "stage_reports", "load_reports", "upsert_reports",
    "keyed_table", "dq_rules", "null_rates", "row_count_monitor", "schema_drift", "drill_volume", "drill_data_quality",
    "run_summary", "run_history", "recent_runs", "unhealed_failures", "freshness_latest", "incident_summary",
    "flatten_reports", "explode_pages", "log_parse", "statement_audit", "route_decisions", "evidence",
    "similar_incidents", "lineage_downstream", "approval_upsert", "escalation_ladder", "stream_ingest",
    "stream_load_counts", "scheduled_load", "paged_stream", "stream_records", "stream_triage", "incident_records",
    "drill_detection", "run_checks", "monitor_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if wanted == ["all"]:
        wanted = list(catalog.QUERIES)
    spark = build_session("bench", cores)
    seconds: dict[str, float] = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": cores,
    }))


if __name__ == "__main__":
    main()
