"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores, BENCH_QUERIES an optional
comma-separated choice of queries, BENCH_RUNS the runs per query (the best one counts).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from catalog.queries import QUERIES
from listwright.session import local_session

HEADLINES = (
    "normalize_names", "strict_names", "parse_emails", "scan_lines", "scan_csv", "dedupe_per_file",
    "dedupe_priority", "dedupe_unordered", "dedupe_lines", "dedupe_trimmed", "incremental_new",
    "with_original", "registered_only", "new_uniques", "stats_total", "stats_report", "export_stats",
    "global_ordinal", "export_blocks", "export_kinds", "split_fixed", "split_comma", "raw_counts",
    "manifest_plan", "stream_dedupe", "consolidate", "consolidate_strict", "consolidate_by_kind",
    "email_report",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINES
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    memory = os.environ.get("BENCH_MEMORY", "16g")
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cores, memory=memory, spark__checkpoint__dir=shared)
    times = {}
    for name in chosen:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
