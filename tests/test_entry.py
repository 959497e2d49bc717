"""The driver contract: entry, queries and oracle SQL."""
import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from rankwise.catalog import QUERIES

TABLES = ["lineitem", "supplier", "events"]


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["geographical_location_oid", "geographical_location",
                          "item_rank", "item_name"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    queries = entry_module.queries()
    oracle = entry_module.oracle_sql()
    assert set(oracle) <= set(queries)
    assert set(QUERIES) <= set(oracle)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle_on_small_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    res = con.execute(entry_module.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=repr)
    df = entry_module.queries()[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(want_cols)
    got = sorted((tuple(r[c] for c in want_cols) for r in df.collect()), key=repr)
    assert got == want


def test_results_do_not_depend_on_session_time_zone(spark):
    name = "dedup_keep_one"
    utc = sorted(tuple(r) for r in entry_module.queries()[name](spark, SF_SMALL).collect())
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = sorted(tuple(r) for r in entry_module.queries()[name](spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert utc == other


def test_entry_works_without_the_training_data_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(entry_module.__file__).parent
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", ".*")
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    done = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"],
        cwd=tmp_path / "copy", env={"PATH": "/usr/bin"}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == sorted(QUERIES), done.stderr[-500:]
