"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` (all registered queries with ``--all``) over
$BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS], forcing
full execution with the no-op sink, and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each query's time is the median of $BENCH_REPEATS runs (default 2) after
one warm-up run of the first query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "zonal_daily", "summarise_temporal", "zonal_basic", "zonal_periodic", "zonal_once",
    "zonal_multiband_complete", "vector_zonal", "cells_in_radius", "asof_items", "merge_windows",
    "attach_vector_all", "capabilities", "covariate_fit", "enrich_catalogue", "zonal_default_radius", "enrich_cadences", "summarise_window_365",
    "zonal_all_stats", "zonal_pyramid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    from covspark.registry import QUERIES
    from covspark.session import local_session

    names = list(QUERIES) if "--all" in sys.argv else [n for n in HEADLINE if n in QUERIES]
    picked = [a for a in sys.argv[1:] if not a.startswith("--")]
    if picked:
        names = picked
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    spark = local_session(cpus, shuffle_partitions=parts, app_name="covspark-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(names[0])  # JVM / codegen warm-up
    times = {}
    for n in names:
        times[n] = round(statistics.median(run(n) for _ in range(repeats)), 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
