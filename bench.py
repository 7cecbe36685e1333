"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default below), BENCH_REPEAT (default 2, best counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickwatch.plans.catalog import QUERIES  # noqa: E402
from clickwatch.session import build_session, drop_staged  # noqa: E402

HEADLINE = (
    "sliding_features", "tumbling_features", "valid_events", "rule_failure_counts", "ingest_quality",
    "clickstream_events", "daily_stats", "geo_stats", "top_recent_events", "lake_hour_counts", "offline_scan",
    "online_latest", "online_lookup", "asof_features", "count_cap", "time_split", "standardized_features",
    "fixed_forest_scores", "anomaly_scores", "flagged_windows", "inject_uniform", "inject_stratified",
    "roc_auc", "forest_evaluation", "latency_p95", "value_auc", "stream_sliding_features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            drop_staged(spark)
        times[name] = round(min(runs), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
