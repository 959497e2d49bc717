"""Skew measures and stage composition."""
import functools

import pytest
from pyspark.sql import functions as F

from rankwise.operators import (choose_salts, count_by_hot_salted, hot_keys, key_skew,
                                partition_sizes, partition_skew)
from rankwise.plans.stages import StageChain


def _layout_100_1_1_1(spark):
    """Partitions holding 100, 1, 1 and 1 rows."""
    part = F.when(F.col("id") < 100, 0).otherwise(F.col("id") - 99)
    return spark.range(0, 103, 1, 1).repartitionByRange(4, part)


def test_partition_skew_detected(spark):
    df = _layout_100_1_1_1(spark)
    assert sorted(r.rows for r in partition_sizes(df).collect()) == [1, 1, 1, 100]
    report = partition_skew(df)
    assert report.skewed and report.factor > 1.5
    assert report.units == 4 and report.rows == 103 and report.largest == 100


def test_partition_skew_balanced(spark):
    report = partition_skew(spark.range(0, 20, 1, 4))
    assert not report.skewed and report.factor <= 1.5


def test_partition_skew_empty(spark):
    report = partition_skew(spark.range(0, 0, 1, 2))
    assert report.factor == 0.0 and not report.skewed


def test_partition_sizes_include_empty_partitions(spark):
    df = spark.range(0, 3, 1, 1).repartition(3, F.lit(0))   # one full, two empty
    sizes = partition_sizes(df, 3).collect()
    assert sorted(r.rows for r in sizes) == [0, 0, 3]
    assert sorted(r.partition_id for r in sizes) == [0, 1, 2]
    assert [r.rows for r in partition_sizes(df).collect()] == [3]
    assert partition_skew(df, partitions=3).factor == 3.0


def test_key_skew(spark):
    df = spark.createDataFrame([("hot",)] * 8 + [("a",), ("b",)], "k string")
    report = key_skew(df, ["k"])
    assert report.units == 3 and report.largest == 8
    assert report.factor == pytest.approx(8 / (10 / 3))
    assert report.skewed


def test_choose_salts():
    assert choose_salts(0.0) == 2
    assert choose_salts(1.98) == 2
    assert choose_salts(3.2) == 4
    assert choose_salts(133_000.0) == 133_000


def test_hot_keys(spark):
    df = spark.createDataFrame([("hot",)] * 80 + [(None,)] * 15 + [("a",)] * 4 + [("b",)],
                               "k string")
    hot = hot_keys(df, ["k"], 10)
    assert dict(zip(hot.keys, hot.salts)) == {("hot",): 8, (None,): 2}
    assert (hot.rows, hot.reducers, hot.skewed) == (100, 10, True)
    assert not hot_keys(df, ["k"], 1).skewed
    assert not hot_keys(df.limit(0), ["k"], 10).skewed
    got = count_by_hot_salted(df.withColumn("id", F.monotonically_increasing_id()), ["k"], hot,
                              salt_from=["id"], name="n")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("hot", 80), (None, 15), ("a", 4), ("b", 1)], key=repr)


# --- composition ----------------------------------------------------------------

def plus_one(df):
    return df.select((F.col("v") + 1).alias("v"))


def times_two(df):
    return df.select((F.col("v") * 2).alias("v"))


def test_stages_runs_in_order(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    out = StageChain([plus_one, times_two])(df)
    assert sorted(r.v for r in out.collect()) == [4, 6, 8]


def test_stages_rejects_non_callables():
    with pytest.raises(TypeError):
        StageChain([plus_one, "not a stage"])


def test_stages_copies_member_list(spark):
    stages = [plus_one]
    pipe = StageChain(stages)
    stages.append(times_two)
    assert pipe.names == ["plus_one"]


def test_stages_metrics_single_action(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    pipe = StageChain([plus_one, functools.partial(times_two)])
    result, metrics = pipe.run(df, lambda d: sorted(r.v for r in d.collect()))
    assert result == [4, 6, 8]
    assert metrics.table() == [(1, "plus_one", 3, 3), (2, "times_two", 3, 3)]
    assert [(r["stage"], r["rows_in"], r["rows_out"]) for r in metrics.records()] == [
        ("plus_one", 3, 3), ("times_two", 3, 3)]
    assert all(p >= 1 for p in metrics.partitions())


def test_stages_metrics_filtering_stage(spark):
    df = spark.range(10).select(F.col("id").alias("v"))
    pipe = StageChain([lambda d: d.filter("v % 2 = 0")], names=["evens"])
    _, metrics = pipe.run(df, lambda d: d.write.format("noop").mode("overwrite").save())
    assert metrics.table() == [(1, "evens", 10, 5)]


def test_stages_metrics_report_partitions(spark):
    df = spark.range(0, 40, 1, 4).select(F.col("id").alias("v"))
    pipe = StageChain([lambda d: d.filter("v < 40")], names=["all"])
    _, metrics = pipe.run(df, lambda d: d.collect())
    assert metrics.partitions() == [4, 4]
    assert metrics.records() == [{"stage_index": 1, "stage": "all", "rows_in": 40,
                                  "rows_out": 40, "used_partitions": 4}]


def test_stages_metrics_on_empty_input(spark):
    df = spark.createDataFrame([], "v long")
    _, metrics = StageChain([plus_one]).run(df, lambda d: d.collect())
    assert metrics.table() == [(1, "plus_one", 0, 0)]


# --- hot keys from a sketch -------------------------------------------------------

def test_sketch_slots_bound_the_error():
    from rankwise.operators.skew import MAP_ERROR, MAX_MAP, sketch_slots
    for reducers in (2, 8, 200, 10_000, 70_000):
        assert MAP_ERROR / sketch_slots(reducers) <= 1 / (4 * reducers)
    assert sketch_slots(10 ** 9) == MAX_MAP


def test_frequent_codes_stay_in_their_bounds(spark):
    """More keys than slots: estimates are bounded, and keys of twice the error are named."""
    from rankwise.operators.skew import frequent_codes
    rows = spark.range(40_000, numPartitions=7).select(
        F.when(F.col("id") % 5 == 0, F.lit("hot")).when(F.col("id") % 17 == 0, F.lit("warm"))
        .otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 2).alias("part"))
    slots = 128
    total, top = frequent_codes(rows, ["k", "part"], slots)
    exact = {r["code"]: r["count"] for r in
             rows.groupBy(F.xxhash64("k", "part").alias("code")).count().collect()}
    error = 3.5 / slots * total
    assert total == 40_000
    assert all(exact[c] <= n <= exact[c] + error for c, n in top.items())
    assert {c for c, n in exact.items() if n > 2 * error} <= set(top)


def test_hot_keys_equal_exact_ones_on_many_keys(spark):
    """The sketch overflows by far; what is hot and its salts are still exact."""
    rows = spark.range(60_000, numPartitions=5).select(
        F.when(F.col("id") % 4 == 0, F.lit(-1)).when(F.col("id") % 9 == 0, F.lit(-2))
        .otherwise(F.col("id")).alias("k"))
    hot = hot_keys(rows, ["k"], 13)
    n = {-1: 15_000, -2: 60_000 // 9 + 1 - (60_000 // 36 + 1)}
    assert hot.keys == [(-1,), (-2,)] and hot.rows == 60_000
    assert hot.salts == [max(2, -(-n[k] * 13 // 60_000)) for k in (-1, -2)]
    assert hot.error <= 1 / 52
    assert not hot_keys(rows.filter("k >= 0"), ["k"], 13).skewed


def test_hot_keys_move_sketches_and_no_keys(spark):
    """One row per task and group goes through the shuffles of the first pass."""
    from rankwise.operators import skew
    rows = spark.range(10_000, numPartitions=6).select(F.col("id").alias("k"))
    taken = []
    real = type(rows).first

    def first(df):
        taken.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)
    type(rows).first = first
    try:
        skew.frequent_codes(rows, ["k"], 64)
    finally:
        type(rows).first = real
    [plan] = taken
    assert "partial_approx_top_k_accumulate" in plan and "hashpartitioning(code" not in plan
    assert "Sort " not in plan
