"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   table folder        (default /root/testdata/sf0.1)
BENCH_CPUS     local cores         (default 8)
BENCH_REPEATS  runs per query; the fastest counts (default 2)
BENCH_QUERIES  comma-separated names instead of the headline list; "all" for all
"""

from __future__ import annotations

import json
import os
import sys
import time

from deskweave.plans import catalog
from deskweave.session import build_session

HEADLINE = (
    "group_priority_rollup",
    "scope_filter",
    "delta_scan",
    "documents_basic",
    "page_cells",
    "redact_chain",
    "byte_truncate",
    "pii_detect",
    "pii_mask",
    "mask_with_detector",
    "latest_version",
    "upsert_snapshot",
    "delta_equals_full",
    "run_stats",
    "stream_upsert_final_state",
    "hash_vectors",
    "cosine_topk",
    "fulltext_topk",
    "batch_retrieval",
    "facets",
    "field_profile",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    asked = os.environ.get("BENCH_QUERIES", "")
    queries = catalog.all_queries()
    names = list(queries) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE

    spark = build_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries["doc_count"](spark, sf_dir).collect()  # start the executor threads
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
