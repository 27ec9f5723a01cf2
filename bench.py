"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query runs once to warm up and then BENCH_RUNS times (default 2); the best time
counts. Building the plan is part of the time, writing the result is not.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "all_cohort_features", "cohort_extract", "iforest_score", "ingest_normalize",
    "ingest_matched", "ip_join_left", "payload_signatures", "hourly_entropy_gini", "gap_stats",
    "max_run_lt", "error_bursts", "ladder_sweep", "signature_stats", "top_signatures",
    "ua_full_diversity", "ua_churn", "order_features", "order_audit", "ewma_history",
    "jaccard_prev_day", "risk_bands", "top_n_per_band", "robust_stats", "normalize_robust",
    "correlation_pairs", "dq_ingest",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))

    from clickcohort.catalog import QUERIES
    from clickcohort.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus), "clickcohort-bench")
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        best = float("inf")
        for attempt in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    match = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(match.group(1)) if match else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
