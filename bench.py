"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional), BENCH_SHUFFLE_PARTITIONS, BENCH_EXTRA_CONF
(JSON).  Every query is fully executed with the ``noop`` sink (all rows
computed, nothing collected on the driver), cold: the cache is cleared before
each query.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chartgrid.session import build_session  # noqa: E402
from chartgrid.catalog.registry import all_queries  # noqa: E402

HEADLINE = ("cohort", "hour_grid", "vitals", "gcs", "labs_hourly", "urine_output", "panel_pivot",
            "art_bg", "hourly_wide", "stay_rollup", "sequence_extract", "asof_lookback",
            "carry_previous", "best_per_group", "median_impute", "sequence_windows", "auc",
            "roc_points", "time_scalars")


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(2 * cpus, 8))))
    extra = json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts, app="chartgrid-bench",
                          extra=extra)
    qs = all_queries()
    # warm-up: JVM, codegen caches and file listing, not timed
    qs["vitals"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    times = {}
    for name in names:
        spark.catalog.clearCache()      # no query profits from another one's cache
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
