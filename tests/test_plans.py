"""Plan-shape checks: exchanges, top-k pruning, broadcast, column pruning."""
import re

from conftest import SF_SMALL, physical_plan
from rankwise import adapters
from rankwise.plans.jobs import top_items, top_items_prepartitioned


def _inputs(spark):
    return (adapters.detections_from_lineitem(spark, SF_SMALL),
            adapters.locations_from_supplier(spark, SF_SMALL))


def test_baseline_plan_shape(spark):
    plan = physical_plan(top_items(*_inputs(spark), 5))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = sorted(re.sub(r"#\d+L?", "", e).rsplit(",", 1)[0] for e in exchanges)
    # id (dedup), location+item (count), location (rank), location (lookup build)
    assert keys == ["detection_oid", "geographical_location_oid",
                    "geographical_location_oid",
                    "geographical_location_oid, item_name"]
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "partial_count" in plan


def test_salted_plan_has_one_more_exchange(spark):
    plan = physical_plan(top_items(*_inputs(spark), 5, salts=3))
    assert plan.count("Exchange hashpartitioning") == 5
    assert "xxhash64(detection_oid" in plan


def test_prepartitioned_plan_saves_an_exchange(spark):
    plan = physical_plan(top_items_prepartitioned(*_inputs(spark), 5))
    # id (dedup), location (shared by count and rank), location (lookup build)
    assert plan.count("Exchange hashpartitioning") == 3


def test_scan_reads_only_needed_columns(spark):
    plan = physical_plan(top_items(*_inputs(spark), 5))
    schema = re.search(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S).group(1)
    assert "l_quantity" not in schema and "l_returnflag" not in schema


def test_lookup_over_limit_is_never_broadcast(spark):
    d, loc = _inputs(spark)
    # The lookup file is tiny, so Spark's own size estimate would broadcast it;
    # over our measured limit the join must stay a shuffle join anyway.
    plan = physical_plan(top_items(d, loc, 5, broadcast_limit=0))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in physical_plan(top_items(d, loc, 5))


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                "FlatMapGroupsInPandas", "MapInArrow", "PythonMapInArrow")


def test_no_registered_query_runs_python_on_rows(spark):
    from rankwise.catalog import QUERIES
    for name, query in QUERIES.items():
        plan = physical_plan(query(spark, SF_SMALL))
        found = [node for node in PYTHON_NODES if node in plan]
        assert not found, f"{name}: {found}"


def test_metrics_keep_the_plan_shape(spark):
    from rankwise.plans.jobs import top_items_stages
    d, loc = _inputs(spark)
    df, _ = top_items_stages(loc, 5).with_metrics(d)
    plan = physical_plan(df)
    assert plan.count("CollectMetrics") == 5          # input + four stages
    assert "WindowGroupLimit" in plan and "partial_count" in plan
    assert plan.count("Exchange hashpartitioning") == 4


def test_an_oversized_text_keyed_lookup_is_merge_joined(spark):
    from rankwise.operators import build_lookup, enrich, lookup_size
    rows = [(f"{i:0500d}", "n") for i in range(1000)]
    lookup = spark.createDataFrame(rows, "k string, v string")
    size = lookup_size(lookup, "k", "v")[1]
    assert size >= 1000 * 500
    seen = spark.createDataFrame([(rows[0][0],)], "k string")
    plan = physical_plan(enrich(seen, build_lookup(lookup, "k", "v"), "k", "v",
                                broadcast_limit=500_000))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_building_a_measure_over_a_shuffled_frame_starts_no_job(spark):
    from rankwise.operators import partition_sizes
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "")
    try:
        df = spark.range(100).repartition(5, "id").groupBy("id").count()
        partition_sizes(df)
        partition_sizes(df, 5)
        assert list(tracker.getJobIdsForGroup("build-only")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_hot_salting_adds_few_groups(spark):
    from pyspark.sql import functions as F

    from rankwise.operators import hot_keys
    li = adapters.detections_from_lineitem(spark, SF_SMALL)
    moved = li.withColumn("k", F.when(F.col("detection_oid") % 3 == 0, F.lit(-1))
                          .otherwise(F.col("detection_oid") % 500))
    reducers = 16
    hot = hot_keys(moved, ["k"], reducers)
    assert hot.keys == [(-1,)] and hot.rows == moved.count()
    distinct = moved.select("k").distinct().count()
    assert distinct + sum(hot.salts) <= distinct + 2 * reducers
    salted = moved.withColumn("s", F.when(F.col("k") == -1, F.pmod(
        F.xxhash64("detection_oid"), F.lit(hot.salts[0]))).otherwise(0))
    assert salted.select("k", "s").distinct().count() <= distinct + 2 * reducers


def test_rank_all_runs_its_input_once(spark, monkeypatch):
    """What is sampled for ranges and what is dealt are files, not the counts' plan."""
    from rankwise.catalog import QUERIES as queries
    frame = type(spark.range(1))
    seen, real = [], frame.repartitionByRange

    def recorded(df, *args):
        seen.append(physical_plan(df))
        return real(df, *args)
    monkeypatch.setattr(frame, "repartitionByRange", recorded)
    out = queries["rank_items_hot"](spark, SF_SMALL)
    [dealt] = seen
    assert "FileScan parquet" in dealt and "Aggregate" not in dealt and "Exchange" not in dealt
    assert "lineitem" not in dealt and "lineitem" not in physical_plan(out)
