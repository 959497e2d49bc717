"""Output whose values share directories by a hash, in files of bounded rows."""
import glob

import pytest
from pyspark.sql import functions as F

from rankwise.session import scratch_path
from rankwise.sources import bucket_name, of_value, read, write


@pytest.fixture(scope="module")
def rows(spark):
    # 300 small values, a hot one with a third of the rows, and null.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") == 1, None)
        .otherwise(F.col("id") % 300).cast("long").alias("loc"), F.col("id"))


def files(path):
    return glob.glob(f"{path}/*/part-*")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_values_share_files(spark, rows, fmt):
    path = write(rows, fmt, scratch_path(spark, "sized"), dated=False, partition_by=["loc"],
                 buckets=4)
    assert len(glob.glob(f"{path}/loc_bucket=*")) == 4 and 4 <= len(files(path)) <= 8
    got = read(spark, fmt, path, schema=rows.schema).select("loc", "id")
    assert got.exceptAll(rows).isEmpty() and got.count() == 3000


def test_large_values_are_split_by_rows(spark, rows):
    path = write(rows, "parquet", scratch_path(spark, "sized"), dated=False,
                 partition_by=["loc"], buckets=4, rows_per_file=200)
    sizes = [spark.read.parquet(f).count() for f in files(path)]
    assert max(sizes) <= 200 and sum(sizes) == 3000 and len(sizes) <= 3000 / 200 + 8


@pytest.mark.parametrize("value", [7, 11, None, 999])
def test_one_value_reads_its_directory(spark, rows, value):
    path = write(rows, "parquet", scratch_path(spark, "sized"), dated=False,
                 partition_by=["loc"], buckets=16)
    found = of_value(spark.read.parquet(path), "loc", value, 16)
    want = rows.filter(F.col("loc").eqNullSafe(F.lit(value).cast("long")))
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in want.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(loc_bucket" in plan


def test_bad_buckets(spark, rows):
    for parts, n in (([], 4), (["loc"], 0)):
        with pytest.raises(ValueError):
            write(rows, "parquet", scratch_path(spark, "sized"), dated=False, partition_by=parts,
                  buckets=n)
    assert bucket_name(["a", "b"]) == "a_b_bucket"


def test_empty_table(spark, rows):
    path = write(rows.limit(0), "json", scratch_path(spark, "sized"), dated=False,
                 partition_by=["loc"], buckets=4)
    assert read(spark, "json", path, schema=rows.schema).count() == 0
