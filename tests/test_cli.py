"""The command line: its options, and runs in a process of their own."""
import os
import subprocess
import sys

import pytest

from conftest import SF_SMALL, tuples
from rankwise import adapters
from rankwise.__main__ import parse_args
from rankwise.plans.jobs import top_items
from rankwise.session import scratch_path
from rankwise.sources import read, write

PATHS = ["--dataset_a_path", "a", "--dataset_b_path", "b", "--output_path", "o"]


def test_cli_defaults_and_choices():
    args = parse_args([*PATHS, "--top-x", "10"])
    assert (args.job, args.top_x, args.input_format, args.null_policy, args.malformed,
            args.multiline, args.no_overwrite) == (
        "baseline", 10, "parquet", "fail", "fail", False, False)
    args = parse_args([*PATHS, "--top-x", "1", "--job", "prepartitioned", "--multiline",
                       "--malformed", "reject", "--run-date", "2026-04-21"])
    assert (args.job, args.malformed, args.multiline, args.run_date) == (
        "prepartitioned", "reject", True, "2026-04-21")


@pytest.mark.parametrize("argv", [
    PATHS, [*PATHS, "--top-x", "1", "--job", "nope"], [*PATHS, "--top-x", "-1"],
    [*PATHS, "--top-x", "1", "--run-date", "21.04.2026"]])
def test_cli_rejects_bad_arguments(argv):
    with pytest.raises(SystemExit):
        parse_args(argv)


def _run(*argv):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    return subprocess.run([sys.executable, "-m", "rankwise", *argv], cwd=root,
                          capture_output=True, text=True, timeout=300)


def test_cli_runs_a_csv_job_once(spark):
    """Every option that reads or writes differently, on the events table; a second
    run must not replace the first one's output."""
    d = adapters.detections_from_events(spark, SF_SMALL)
    loc = adapters.locations_from_supplier(spark, SF_SMALL)
    base = scratch_path(spark, "cli")
    argv = ["--job", "prepartitioned", "--dataset_a_path", write(d, "csv", base + "/a", dated=False),
            "--dataset_b_path", write(loc, "csv", base + "/b", dated=False),
            "--output_path", base + "/top.json", "--top-x", "2", "--input-format", "csv",
            "--output-format", "json", "--multiline", "--malformed", "reject",
            "--identical-duplicates", "--no-overwrite", "--run-date", "2026-04-21"]
    first = _run(*argv)
    assert first.returncode == 0, first.stderr[-2000:]
    assert '"stage": "top_x"' in first.stderr and "0 malformed records" in first.stderr
    want = top_items(d, loc, 2)
    out = read(spark, "json", base + "/2026-04-21/top.json").select(*want.columns)
    assert tuples(out) == tuples(want)
    assert _run(*argv).returncode != 0
