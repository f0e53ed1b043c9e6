"""Benchmark the headline reports on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query is executed in full with the ``noop`` sink (every row computed, nothing collected);
the reported time is the median of BENCH_RUNS warm runs, after a warm-up pass over all queries
and one more warm-up run of each query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from venue_analytics.plans.registry import QUERIES  # noqa: E402
from venue_analytics.session import get_spark  # noqa: E402

HEADLINE = [
    "content_types_long", "reviews_long", "keywords_long", "interactions_long",
    "response_times", "posters_long", "segments_long",
    "segment_check", "merchant_post_count", "tagged_post_count", "user_likes", "keyword_mentions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    # one shuffle partition per local core (AQE coalesces further); on a cluster this comes from the
    # cluster configuration (about input bytes / 128 MB)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app_name="venue_analytics_bench")
    # one pass over every query first: JIT-compiles the shared code paths so the first query
    # timed is not charged for the whole process warm-up
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, spread = {}, {}
    load = os.getloadavg()[0]
    t0 = time.thread_time()
    sum(range(5_000_000))
    spin = round(time.thread_time() - t0, 3)  # seconds of a fixed loop: how fast this machine is just now
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM and the OS file cache
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        spread[name] = [round(min(samples), 3), round(max(samples), 3)]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_report_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs, "spread": spread,
                      "machine": {"cores": os.cpu_count(), "load_at_start": round(load, 2), "spin_s": spin}}))


if __name__ == "__main__":
    main()
