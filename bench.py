"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; the fastest run counts. Results go to
Spark's ``noop`` sink, so all rows are computed and none are carried to the driver. Queries that write
(appends, snapshots, streams) include their writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ferryline.plans.registry import QUERIES
from ferryline.session import local_session
from ferryline.sources.collections import table

# Query -> table whose rows it works through.
HEADLINES = {
    "status_overview": "orders",
    "make_batches": "orders",
    "publish_batches": "orders",
    "unwrap_batches": "orders",
    "keyed_update": "orders",
    "archive_flow": "orders",
    "archive_reconcile_missing": "orders",
    "latest_archive": "orders",
    "bulk_update_flow": "orders",
    "bulk_update_stream": "orders",
    "archive_stream": "orders",
    "update_join": "lineitem",
    "latest_state": "events",
    "job_progress": "events",
    "processing_timeout": "events",
    "delivery_order": "events",
    "topic_route": "events",
    "split_outcomes": "events",
    "failure_flow": "events",
    "throughput": "events",
    "stream_handler": "events",
    "job_status_stream": "events",
    "synth_items": "orders",
    "append_valid": "orders",
    "validate_rows": "orders",
    "clear_tables": "orders",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "bench")
    rows = {name: table(spark, folder, name).count() for name in set(HEADLINES.values())}
    seconds, rates = {}, {}
    for name, source in HEADLINES.items():
        best = float("inf")
        for attempt in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if attempt:
                best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
        rates[name] = round(rows[source] / best)
        print(f"{name:28s} {best:7.3f}s {rates[name]:>10,d} rows/s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "rows_per_second": rates, "cpus": cpus, "runs": runs,
        "config": {"spark.sql.shuffle.partitions": cpus, "spark.sql.adaptive.enabled": "true"},
    }))


if __name__ == "__main__":
    main()
