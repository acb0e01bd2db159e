"""Benchmark: runs the headline queries and prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query is
executed in full with the ``noop`` sink (all stages run, nothing is
collected to the driver); the reported time is the best of
``BENCH_REPEAT`` runs after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from onsetlake.plans import queries as q  # noqa: E402
from onsetlake.session import build_session  # noqa: E402

HEADLINE = (
    "onset_ranks",
    "continent_outbreak_rank",
    "predictor_locations",
    "predictor_locations_supplier",
    "clean_variants_csv",
    "dq_constraints",
    "dq_reconcile",
    "curated_join",
    "event_window_means",
    "correlation_matrix",
    "sampling_gap_histogram",
    "cumulative_by_variant",
    "serving_dashboard",
    "global_early_hit",
    "numeric_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="onsetlake-bench")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # session warm-up
    times = {}
    for name in names:
        fn = getattr(q, name)
        best = None
        for _ in range(max(1, repeat)):
            spark.catalog.clearCache()  # every run is cold
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
