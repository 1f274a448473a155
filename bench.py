"""Time the headline queries on one scale factor; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Each query runs once to warm
up the JVM and caches of file metadata, then ``BENCH_REPEAT`` timed runs
(default 3); the median counts, as single runs vary a lot on a shared host.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.plans import registry  # noqa: E402
from kestrel.session import local_session  # noqa: E402

HEADLINE = [
    "rule_match_inner", "age_range", "consume_cycle", "pay_type_top1", "rfm_scores",
    "rfe_scores", "psm_score", "usg_share_label", "dict_encode", "condition_filter",
    "click_ratings", "profile_upsert", "to_cells", "drop_malformed", "order_cleanup",
    "tag_path", "rfm_kmeans", "rfm_scaled_kmeans", "bp_als_top5", "als_explicit_rmse",
    "usg_tree", "vector_elbow", "linreg", "psm_kmeans", "gbt",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    qs = registry.queries()
    times = {}
    for name in names:
        fn = qs[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(max(1, repeat)):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
