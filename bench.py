"""Benchmark the headline datasets.

Runs the per-site datasets and views on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is executed to completion with the no-op sink (full computation,
no driver collect) once to warm up and once timed; the reported value is the
sum of the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adledger.plans.catalog import QUERIES  # noqa: E402
from adledger.session import build_session  # noqa: E402

HEADLINE = [
    "ppc_creatives_daily",
    "display_creatives_daily",
    "ppc_keywords_daily",
    "display_keywords_daily",
    "social_ads_daily",
    "view_all_ppc_creatives",
    "view_all_ppc_keywords",
    "view_social",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          **{"spark.driver.memory": "16g"})
    times = {}
    for name in HEADLINE:
        # One untimed run first (JVM JIT and whole-stage code generation), then
        # the timed run; the cache is cleared before each so that no run reuses
        # data persisted by another.
        for timed in (False, True):
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_datasets_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
