"""Time all queries of the main library at one scale factor.

Each query is planned from scratch and run to completion with the ``noop``
sink (every row is produced, nothing is collected to the driver). Every
query runs ``BENCH_REPEAT`` times (default 3) and the best time is kept.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.
"""
from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankwise.adapters import locations_from_supplier  # noqa: E402
from rankwise.catalog import HOT_REDUCERS, QUERIES, TOP_X, third_at_one_key  # noqa: E402
from rankwise.operators import hot_keys  # noqa: E402
from rankwise.plans.jobs import top_items_stages  # noqa: E402
from rankwise.session import local_session  # noqa: E402


def detection_side_shuffles(spark, sf_dir) -> dict[str, int]:
    """
    compares (3 / 4 / 2); the lookup's side is not in these plans."""
    rows = third_at_one_key(spark, sf_dir)
    names = locations_from_supplier(spark, sf_dir)
    hot = hot_keys(rows, ["geographical_location_oid", "item_name"], HOT_REDUCERS)
    if not hot.skewed:
        raise AssertionError("no hot key in data that has one")
    shapes = {"top_items_baseline": {}, "top_items_skew_aware": {"hot": hot},
              "top_items_prepartitioned": {"prepartition": True}}
    out = {}
    for name, options in shapes.items():
        chain = top_items_stages(names, TOP_X, **options).before("enrich")
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            chain(rows).explain()
        out[name] = shown.getvalue().count("Exchange hashpartitioning")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, cpus, app="rankwise-bench")
    spark.sparkContext.setLogLevel("ERROR")

    # Warm-up: JVM class loading and codegen caches for every query shape,
    # on the smallest data.
    for name in names:
        QUERIES[name](spark, "/root/testdata/sf0.001") \
            .write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    exchanges = detection_side_shuffles(spark, sf_dir)
    spark.stop()

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "detection_side_shuffles": exchanges,
    }))


if __name__ == "__main__":
    main()
