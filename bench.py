"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is timed end to end (plan + full execution into the ``noop`` sink,
which runs every task as a write would, without pulling rows to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "curate_items",
    "group_distribution",
    "select_groups_variety",
    "sample_per_group",
    "feature_importance",
    "eval_audio",
    "knn_topk",
    "tfidf",
    "eval_audio_text",
    "delta_flagged",
    "lookup_input_top",
    "resolve_lookups",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from grouprank.plans.queries import QUERIES
    from grouprank.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, driver_memory="6g")
    # warm up the JVM and the parquet readers on a tiny query
    QUERIES["group_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
