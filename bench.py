"""Time the headline queries.  Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run to completion with a no-op sink (``write.format('noop')``),
so the whole plan executes without a driver collect.  Every query first runs
once on the smallest fixture (sf0.001), so JVM class loading and code
generation are not charged to whichever query is timed first.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(QUERIES)
    spark = get_session(f"local[{cpus}]", app_name="tidemark-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
