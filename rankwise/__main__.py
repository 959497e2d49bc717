"""Command line: run the top-X job once and write the dated result.

    python -m rankwise --job baseline \\
        --dataset_a_path detections.parquet --dataset_b_path locations.parquet \\
        --output_path out/ --top-x 10

On a cluster: ``spark-submit --py-files rankwise.zip rankwise/__main__.py``
with the same arguments. The session comes from ``spark-submit`` /
``SparkSession.builder``; its configuration (master, shuffle partitions,
AQE) is the caller's.
"""
from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from rankwise.plans.jobs import JOBS, run_top_items_job
from rankwise.sources.formats import FORMATS
from rankwise.sources.paths import run_date_text


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rankwise",
                                     description="Top X items per location.")
    parser.add_argument("--job", choices=JOBS, default="baseline")
    parser.add_argument("--dataset_a_path", required=True, help="detections input")
    parser.add_argument("--dataset_b_path", required=True, help="locations input")
    parser.add_argument("--output_path", required=True, help="base output path")
    parser.add_argument("--top-x", dest="top_x", type=int, required=True)
    parser.add_argument("--input-format", default="parquet", choices=sorted(FORMATS))
    parser.add_argument("--output-format", default="parquet", choices=sorted(FORMATS))
    parser.add_argument("--run-date", default=None, type=run_date_text,
                        help="YYYY-MM-DD (default today)")
    parser.add_argument("--null-policy", default="fail",
                        choices=["keep", "drop", "default", "fail"])
    parser.add_argument("--no-overwrite", action="store_true",
                        help="fail if the dated output already exists")
    parser.add_argument("--malformed", default="fail", choices=["fail", "reject"],
                        help="csv and json records that do not parse: fail, or leave out and count")
    parser.add_argument("--multiline", action="store_true",
                        help="csv: quoted line breaks belong to a value")
    parser.add_argument("--identical-duplicates", action="store_true",
                        help="copies of a detection id are identical: faster dedup")
    args = parser.parse_args(argv)
    if args.top_x < 0:
        parser.error("--top-x must be >= 0")
    return args


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    log = logging.getLogger("rankwise")
    spark = SparkSession.builder.appName(f"rankwise-{args.job}").getOrCreate()
    try:
        run = run_top_items_job(
            spark, args.dataset_a_path, args.dataset_b_path, args.output_path,
            args.top_x, job=args.job, input_format=args.input_format,
            output_format=args.output_format, run_date=args.run_date,
            null_policy=args.null_policy,
            mode="errorifexists" if args.no_overwrite else "overwrite",
            assume_identical=args.identical_duplicates,
            malformed=args.malformed, multiline=args.multiline)
        if run.decision is not None:
            log.info("hot keys: %d, salts: %d", len(run.decision.hot.keys),
                     sum(run.decision.hot.salts))
        for record in run.metrics.records():
            log.info(json.dumps(record))
        log.info("wrote %s in %.2fs", run.output_path, run.metrics.seconds or 0.0)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
