"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is timed from construction (which includes its eager
checkpoints) to a full execution through the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapdiff.plans.catalog import QUERIES  # noqa: E402
from snapdiff.session import local_session  # noqa: E402

HEADLINE = [
    "detect_changes",
    "best_match",
    "simrank_pairs",
    "label_match",
    "connected_components",
    "connected_components_sparse",
    "partition_nodes",
    "sharded_match",
    "sharded_match_sparse",
    "classify_changes",
    "evaluate_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(os.environ.get("BENCH_PARTITIONS", "8")), app="snapdiff-bench")
    # warm-up: JVM/JIT and codegen on the smallest tables only; each timed query
    # derives its snapshots from the measured tables anew, inside its own time
    tiny = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(tiny) and os.path.abspath(tiny) != os.path.abspath(sf_dir):
        QUERIES["detect_changes"](spark, tiny).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
