"""Output with one directory per value: made by all tasks, listed by few."""
import collections
import glob
import os

import pytest
from pyspark.sql import functions as F

from rankwise.session import held_setting, scratch_path
from rankwise.sources import read, write
from rankwise.sources.formats import LISTING_TASKS, LISTING_TASKS_PER_CORE

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def written(path):
    """Directory of a value -> the tasks that wrote its files."""
    found = collections.defaultdict(list)
    for f in glob.glob(f"{path}/*/part-*"):
        found[os.path.basename(os.path.dirname(f))].append(os.path.basename(f).split("-")[1])
    return found


@pytest.mark.parametrize("fmt", ["parquet", "txt"])
def test_small_values_are_dealt_to_all_tasks(spark, fmt):
    rows = spark.range(3000).select((F.col("id") % 300).alias("loc"), F.col("id").cast("string"))
    found = written(write(rows, fmt, scratch_path(spark, "dealt"), dated=False, partition_by=["loc"]))
    by_task = collections.Counter(t for tasks in found.values() for t in tasks)
    assert len(found) == 300 and all(len(tasks) == 1 for tasks in found.values())
    assert len(by_task) >= 8 and max(by_task.values()) <= 100


def test_buckets_are_dealt_to_all_tasks(spark):
    path = write(spark.range(3000), "parquet", scratch_path(spark, "dealt"), dated=False,
                 partition_by=["id"], buckets=64)
    assert len({t for tasks in written(path).values() for t in tasks}) >= 6


def test_a_hot_value_is_still_cut(spark):
    rows = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 1000).otherwise(-1).alias("loc"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    with held_setting(spark, ADVISORY, "64k"):
        path = write(rows, "parquet", scratch_path(spark, "dealt"), dated=False,
                     partition_by=["loc"])
    found = written(path)
    assert len(set(found["loc=-1"])) > 1 and len(found) == 11
    back = read(spark, "parquet", path).select(F.col("loc").cast("long").alias("loc"), "text")
    assert back.exceptAll(rows).isEmpty() and back.count() == 40000


def test_null_and_absent_rows(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), (3, 2), (None, None)], "loc long, n long")
    path = write(rows, "parquet", scratch_path(spark, "dealt"), dated=False, partition_by=["loc"])
    got = read(spark, "parquet", path, schema=rows.schema)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    none = write(rows.limit(0), "parquet", scratch_path(spark, "dealt"), dated=False,
                 partition_by=["loc"])
    assert not written(none)


def test_directories_are_listed_by_few_tasks(spark):
    sc = spark.sparkContext
    most = LISTING_TASKS_PER_CORE * sc.defaultParallelism
    path = write(spark.range(most + 40).withColumn("n", F.lit(1)), "parquet",
                 scratch_path(spark, "dealt"), dated=False, partition_by=["id"])
    before = spark.conf.get(LISTING_TASKS)
    sc.setJobGroup("listing", "")
    try:
        back = read(spark, "parquet", path)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [status.getStageInfo(s) for job in status.getJobIdsForGroup("listing")
              for s in status.getJobInfo(job).stageIds]
    assert max(s.numTasks for s in stages) == most
    assert back.count() == most + 40 and spark.conf.get(LISTING_TASKS) == before


def test_held_settings_overlap_and_are_put_back(spark):
    key = "spark.rankwise.test"
    with pytest.raises(KeyError):
        with held_setting(spark, key, "a"):
            with held_setting(spark, key, "b"):
                assert spark.conf.get(key) == "b"
            raise KeyError
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "own")
    with held_setting(spark, key, "a"):
        assert spark.conf.get(key) == "a"
    assert spark.conf.get(key) == "own"
    spark.conf.unset(key)
