"""Time the headline queries: ``BENCH_SF_DIR`` (tables) and ``BENCH_CPUS`` (cores); one JSON line.

Each query's full result goes to the no-op sink. Name queries as arguments to time others.
"""

from __future__ import annotations

import json
import os
import sys
import time

from eventide.catalog.queries import QUERIES
from eventide.session import build_session

HEADLINE = [
    "tumbling_count", "page_views", "top_n_per_window", "sliding_count", "sliding_rate", "rate_anomaly",
    "session_metrics_30m", "session_metrics_12h", "assign_sessions_30m", "session_summary_30m", "funnel",
    "abandoned_carts", "channel_journeys", "classify_lateness", "counts_with_late", "late_event_stats", "firings",
    "count_windows", "interval_join", "asof_join", "valid_events", "stream_tumbling_count",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "eventide-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["tumbling_count"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up is not timed

    took: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
