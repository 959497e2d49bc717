"""Throughput of the baseline job as the input grows, with a stage breakdown.

    python tools/scale_check.py [sf_dir] [copies ...]      (default: sf0.1, 1 4 16)

The input is N copies of the lineitem detections with disjoint ids, so the
scan has N splits and the answer differs only in counts. For the largest N,
Spark's event log (written to a fresh folder under /tmp) gives per-stage
durations and shuffle bytes. A measurement aid, not a registered query.
"""
from __future__ import annotations

import functools
import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rankwise import adapters  # noqa: E402
from rankwise.plans.jobs import top_items  # noqa: E402


def _copies(spark, sf, n):
    parts = [adapters.detections_from_lineitem(spark, sf)
             .withColumn("detection_oid", F.col("detection_oid") + F.lit(k * 10 ** 10))
             for k in range(n)]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def _stages(log_dir):
    path = [p for p in glob.glob(f"{log_dir}/**/*", recursive=True)
            if os.path.basename(p).startswith("events_")][0]
    stages = []
    for line in open(path):
        event = json.loads(line)
        if event["Event"] != "SparkListenerStageCompleted":
            continue
        info = event["Stage Info"]
        written = sum(int(a.get("Value", 0)) for a in info.get("Accumulables", [])
                      if a.get("Name") == "internal.metrics.shuffle.write.bytesWritten")
        stages.append((info["Submission Time"], info["Stage ID"], info["Number of Tasks"],
                       info["Completion Time"] - info["Submission Time"], written))
    return sorted(stages)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    counts = [int(c) for c in sys.argv[2:]] or [1, 4, 16]
    log_dir = tempfile.mkdtemp(prefix="rankwise-events-")
    spark = (SparkSession.builder.master("local[8]").appName("rankwise-scale")
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
    loc = adapters.locations_from_supplier(spark, sf)
    rows_per_copy = adapters.detections_from_lineitem(spark, sf).count()
    last_start = None
    for n in counts:
        detections = _copies(spark, sf, n)
        best = float("inf")
        for _ in range(2):
            start_ms = int(time.time() * 1000)
            t0 = time.perf_counter()
            top_items(detections, loc, 5).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            if elapsed < best:
                best, last_start = elapsed, start_ms
        rows = rows_per_copy * n
        print(f"copies={n:3d} rows={rows:>11,} seconds={best:6.2f} rows/s={rows / best:>12,.0f}")
    spark.stop()
    print(f"stages of the best run with {counts[-1]} copies:")
    for submitted, stage, tasks, ms, written in _stages(log_dir):
        if submitted >= last_start:
            print(f"  stage {stage:4d} tasks={tasks:4d} ms={ms:6d} "
                  f"shuffle_write_MB={written / 1e6:8.1f}")


if __name__ == "__main__":
    main()
