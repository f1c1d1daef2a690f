"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is forced to completion with the ``noop`` sink (full compute,
nothing collected to the driver).  A warm-up query runs first so JVM start
and the first file listing are not charged to the first measured query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_and_count",
    "cleaned_documents",
    "normalize_whitespace",
    "keyword_any",
    "exact_dedup",
    "best_per_group",
    "group_size",
    "near_dup_pairs",
    "near_dup_drop_earliest",
    "near_dup_drop_greedy",
    "resume_anti_join",
    "multi_dim_counts",
    "consecutive_runs",
    "running_tally",
    "throughput_eta",
    "first_crossing",
    "cap_per_session",
    "jsonl_scan_tolerant",
    "stream_dedup",
    "clean_dataset",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from tidewash.queries import QUERIES
    from tidewash.session import local_session
    from tidewash.sources.tables import TEXT_PARTITIONS

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app_name="tidewash-bench")
    # the tables are a few big row groups: spread them before per-row text work
    spark.conf.set(TEXT_PARTITIONS, str(2 * spark.sparkContext.defaultParallelism))
    QUERIES["group_count_sorted"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr)
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
