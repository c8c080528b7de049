"""Time the headline queries: prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Each time is the median of
BENCH_RUNS runs into a no-op sink, after one warm-up run of the first query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from gridmend.plans.catalog import QUERIES
from gridmend.session import local_session

HEADLINE = (
    "non_polar_dtr_ceiling", "wet_day_pre", "interpolate_gaps", "convert_360_day_noleap", "doy_window_pool", "train_qdm",
    "train_qdm_suppliers", "sim_quantile", "apply_qdm", "apply_qdm_suppliers", "train_qplad", "apply_qplad",
    "regrid_bilinear", "regrid_conservative", "rechunk", "validate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "gridmend-bench", shuffle_partitions=cores)

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once(HEADLINE[0])
    once("apply_qdm")
    seconds = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf, "cores": cores}))
    spark.stop()


if __name__ == "__main__":
    main()
