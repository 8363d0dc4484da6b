"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query runs to completion through the no-op sink (nothing is collected).
Before timing, every headline query runs once, untimed, on the smallest
driver data set ($BENCH_WARMUP_DIR, default sf0.001): that pays the per-JVM
costs (JIT, expression codegen, Python workers) so the timed runs measure
steady-state work at $BENCH_SF_DIR.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans.queries import QUERIES  # noqa: E402
from ledgerloom.session import get_spark  # noqa: E402

HEADLINE = [
    "spend_by_category",
    "spend_by_category_resolved",
    "spend_report_json",
    "spend_by_column",
    "spend_share",
    "amounts_clean",
    "dates_clean",
    "fx_convert",
    "merchants_resolve",
    "merchants_varied",
    "transactions_enriched",
    "categories_full",
    "merchants_vector",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:  # untimed warm-up at the smallest scale
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
