"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
Each query runs to the end with all its columns; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from trackloom.plans.catalog import REGISTRY  # noqa: E402
from trackloom.session import local_session  # noqa: E402

HEADLINE = [
    "gap_summary",
    "decode_raw",
    "to_processed",
    "flatten_export",
    "quarantine_batches",
    "batch_summary",
    "snap_to_road",
    "impute_gaps",
    "smooth_devices",
    "smooth_batches",
]
RUNS = 2


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, "bench")
    timed = {
        name: round(min(seconds(lambda q=REGISTRY[name]: q(spark, sf_dir)) for _ in range(RUNS)), 3)
        for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
