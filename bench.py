"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Every query is executed in full with the ``noop`` sink (no collect to the driver).
A warm-up query runs first so JVM start-up and Python worker start are not billed to
the first measured query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regalign.plans.catalog import QUERIES  # noqa: E402
from regalign.session import local_session  # noqa: E402

HEADLINE = [
    "normalize_names",
    "name_similarity",
    "matches",
    "harmonize",
    "collapse_by_id",
    "merge_upsert",
    "merge_stats",
    "as_of_version",
    "expire",
    "snapshot_log",
    "high_profit",
    "top_revenue",
    "prepare_training",
    "scaled_features",
    "metrics_auc",
    "model_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="regalign-bench")
    # warm-up on the smallest tables (JIT, codegen, Python workers); not timed
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("list_sizes", "name_similarity", "model_metrics"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
