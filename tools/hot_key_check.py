"""Does a hot key create a straggler? Task-time spread with and without one.

    python tools/hot_key_check.py [sf_dir] [copies] [pair|id|wide]   (default: sf0.1, 16, pair)

Runs the baseline job twice over N copies of the lineitem detections (ids
kept disjoint): once as is, once with a third of every copy moved to one
(location, item) -- or, with ``id``, given one shared detection id (copies
with conflicting payloads), or, with ``wide``, moved to one location with a
distinct item per row (millions of items to rank in one group). Spark's event log (a fresh folder under /tmp) gives each
stage's median and maximum task time. A measurement aid, not a registered
query.
"""
from __future__ import annotations

import functools
import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rankwise import adapters  # noqa: E402
from rankwise.contracts import DEFAULT_COLUMNS as C  # noqa: E402
from rankwise.plans.jobs import top_items  # noqa: E402


def _detections(spark, sf, copies, hot, mode):
    parts = []
    for k in range(copies):
        d = (adapters.detections_from_lineitem(spark, sf)
             .withColumn(C.detection, F.col(C.detection) + F.lit(k * 10 ** 10)))
        if hot:
            chosen = (F.col(C.detection) % 3) == 0
            if mode == "id":
                d = d.withColumn(C.detection,
                                 F.when(chosen, F.lit(-1)).otherwise(F.col(C.detection)))
            elif mode == "wide":
                unique_item = F.concat(F.lit("u"), F.col(C.detection).cast("string"))
                d = (d.withColumn(C.item, F.when(chosen, unique_item).otherwise(F.col(C.item)))
                      .withColumn(C.location,
                                  F.when(chosen, F.lit(0)).otherwise(F.col(C.location))))
            else:
                d = (d.withColumn(C.location,
                                  F.when(chosen, F.lit(0)).otherwise(F.col(C.location)))
                      .withColumn(C.item,
                                  F.when(chosen, F.lit("hot")).otherwise(F.col(C.item))))
        parts.append(d)
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    mode = sys.argv[3] if len(sys.argv) > 3 else "pair"
    log_dir = tempfile.mkdtemp(prefix="rankwise-events-")
    spark = (SparkSession.builder.master("local[8]").appName("rankwise-hot-key")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.dir", log_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    locations = adapters.locations_from_supplier(spark, sf)
    windows = {}
    for hot in (False, True):
        result = top_items(_detections(spark, sf, copies, hot, mode), locations, 5)
        result.write.format("noop").mode("overwrite").save()          # warm-up
        start, t0 = int(time.time() * 1000), time.perf_counter()
        result.write.format("noop").mode("overwrite").save()
        windows[hot] = (start, int(time.time() * 1000))
        print(f"{'hot ' if hot else 'flat'} seconds={time.perf_counter() - t0:.2f}")
    spark.stop()

    path = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True)
            if os.path.basename(p).startswith("events_")][0]
    tasks: dict[int, list[tuple[int, int]]] = {}
    for line in open(path):
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            info = event["Task Info"]
            tasks.setdefault(event["Stage ID"], []).append(
                (info["Launch Time"], info["Finish Time"] - info["Launch Time"]))
    for hot, (begin, end) in windows.items():
        print("hot key:" if hot else "no hot key:")
        for stage, items in sorted(tasks.items()):
            if len(items) > 1 and all(begin <= launched <= end for launched, _ in items):
                times = sorted(ms for _, ms in items)
                print(f"  stage {stage:4d} tasks={len(times):3d} "
                      f"median_ms={statistics.median(times):7.0f} max_ms={times[-1]:7d}")


if __name__ == "__main__":
    main()
