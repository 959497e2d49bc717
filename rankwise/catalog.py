"""Registered queries: one per operator / job, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the shared test tables (through ``rankwise.adapters``)
in full. Queries that exercise sinks write under the cluster-shared
folder (``rankwise.session.scratch_path``) and read the result back.
"""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from rankwise import adapters
from rankwise.contracts import DEFAULT_COLUMNS as C
from rankwise.contracts import DETECTIONS, OUTPUT, conform
from rankwise.operators import (build_lookup, count_by, count_by_hot_salted,
                                count_by_salted, dedup_keep_one, enrich, hot_keys,
                                key_skew_frame, partition_sizes, top_per_group)
from rankwise.operators.skew import MAP_ERROR, frequent_codes, sketch_slots
from rankwise.plans.jobs import (count_stage, dedup_stage, multiset_difference,
                                 run_top_items_job, top_items, top_items_stages,
                                 top_items_prepartitioned, top_items_skew_aware,
                                 top_stage)
from rankwise.plans.stages import StageChain
from rankwise.session import remove_path, scratch_path
from rankwise.sources import (dated_output_path, read, read_checked, split_rejects, write,
                              write_split)

# Query parameters.
TOP_X = 5            # lineitem-based jobs
TOP_X_EVENTS = 3     # events-based jobs
SALTS = 4            # explicit salt count for the salted-count query
RUN_DATE, NEXT_DATE = "2026-04-21", "2026-04-22"
NULL_ITEM = "item-7"       # item value turned into null for null-policy queries
NULL_ID_LINE = 7           # line number whose detection id becomes null
CUT_LINE, SHORT_LINE = 3, 5        # line numbers of cut records, and of ones without names
BAD_ID_LINE = 7            # line number whose detection id becomes unreadable text
HOT_REDUCERS = 16          # reducers that hot keys are measured against
LAYOUT_PARTITIONS = 4      # partitions of the measured layout, one left empty
LOCATION_BUCKETS = 8       # directories that the locations of an output share
ODD_ENDS = [",x", "\ny", '"z"', "\\w", ""]      # item endings, by rank

Query = Callable[[SparkSession, str], DataFrame]


def _li(spark, sf):
    return adapters.detections_from_lineitem(spark, sf)


def _sup(spark, sf):
    return adapters.locations_from_supplier(spark, sf)


def _ev(spark, sf):
    return adapters.detections_from_events(spark, sf)


def _deduped(spark, sf):
    return dedup_stage()(_li(spark, sf))


def _counts(spark, sf):
    return count_stage()(_deduped(spark, sf))


def _baseline(spark, sf, top_x=TOP_X):
    return top_items(_li(spark, sf), _sup(spark, sf), top_x)


# --- jobs -------------------------------------------------------------------

def q_top_items_baseline(spark, sf):
    return _baseline(spark, sf)


def q_top_items_skew_aware(spark, sf):
    return top_items_skew_aware(_li(spark, sf), _sup(spark, sf), TOP_X)[0]


def q_top_items_prepartitioned(spark, sf):
    return top_items_prepartitioned(_li(spark, sf), _sup(spark, sf), TOP_X)


def q_top_items_events(spark, sf):
    return top_items(_ev(spark, sf), _sup(spark, sf), TOP_X_EVENTS)


def q_top_items_events_identical(spark, sf):
    return top_items(_ev(spark, sf), _sup(spark, sf), TOP_X_EVENTS,
                     assume_identical=True)


def q_top_items_events_skew_aware(spark, sf):
    return top_items_skew_aware(_ev(spark, sf), _sup(spark, sf), TOP_X_EVENTS)[0]


def _salted(detections, locations):
    """The skew-aware job on detections with a hot key: it must salt."""
    result, decision = top_items_skew_aware(detections, locations, TOP_X, reducers=HOT_REDUCERS)
    if not decision.salted:
        raise AssertionError("the skew-aware job found no hot key to salt")
    return result, decision


def q_top_items_hot_key(spark, sf):
    """The skew-aware job where a key has a third of all rows: the salted branch."""
    return _salted(third_at_one_key(spark, sf), _sup(spark, sf))[0]


def q_skew_decision(spark, sf):
    """What the skew-aware job decided: its hot keys, each with its buckets."""
    hot = _salted(third_at_one_key(spark, sf), _sup(spark, sf))[1].hot
    return spark.createDataFrame(
        [(location, item, salts) for (location, item), salts in zip(hot.keys, hot.salts)],
        StructType([*[f for f in DETECTIONS.fields if f.name in (C.location, C.item)],
                    StructField("salts", LongType())]))


def q_frequent_key_estimates(spark, sf):
    """Estimates of the sketch against exact counts: hot keys named, and kept bounds."""
    rows = third_at_one_key(spark, sf)
    keys, slots = [C.location, C.item], sketch_slots(HOT_REDUCERS)
    total, top = frequent_codes(rows, keys, slots)
    named = spark.createDataFrame(list(top.items()), "code long, estimate long")
    exact = count_by(rows, keys, "rows").withColumn("code", F.xxhash64(*keys))
    met = exact.join(named, "code", "left")
    share, error = F.col("rows") * HOT_REDUCERS > total, int(MAP_ERROR / slots * total)
    return met.agg(
        F.sum("rows").alias("rows"), F.count_if(share).alias("hot_keys"),
        F.count_if(share & F.col("estimate").isNotNull()).alias("hot_keys_named"),
        F.count_if((F.col("estimate") < F.col("rows"))
                   | (F.col("estimate") > F.col("rows") + error)).alias("out_of_bounds"))


def q_jobs_equivalence(spark, sf):
    """The salted job against the plain one, where there is a key to salt."""
    rows, names = third_at_one_key(spark, sf), _sup(spark, sf)
    return multiset_difference(top_items(rows, names, TOP_X), _salted(rows, names)[0])


def _job_from_files(spark, sf, fmt, job):
    """The file-to-file job (as the CLI runs it) on the adapted tables."""
    base = scratch_path(spark, f"job-{fmt}")
    a = write(_li(spark, sf), fmt, base + "/in/detections", dated=False)
    b = write(_sup(spark, sf), fmt, base + "/in/locations", dated=False)
    run = run_top_items_job(spark, a, b, base + "/out/", TOP_X, job=job,
                            input_format=fmt, run_date=RUN_DATE)
    remove_path(spark, base + "/in")
    return read(spark, "parquet", run.output_path, schema=OUTPUT)


def q_job_run_parquet(spark, sf):
    return _job_from_files(spark, sf, "parquet", "baseline")


def q_job_run_csv_skew_aware(spark, sf):
    return _job_from_files(spark, sf, "csv", "skew_aware")


def q_job_run_json_prepartitioned(spark, sf):
    return _job_from_files(spark, sf, "json", "prepartitioned")


# --- operators ----------------------------------------------------------------

def q_dedup_keep_one(spark, sf):
    return dedup_keep_one(_li(spark, sf), C.detection, C.dedup_order)


def q_count_by_keys(spark, sf):
    return count_by(_deduped(spark, sf), [C.location, C.item], C.count)


def q_count_by_keys_salted(spark, sf):
    return count_by_salted(_deduped(spark, sf), [C.location, C.item], SALTS,
                           salt_from=[C.detection], name=C.count)


def third_at_one_key(spark, sf):
    """Detections of which a third are moved to one location and item."""
    moved = F.col(C.detection) % 3 == 0
    return (_li(spark, sf)
            .withColumn(C.item, F.when(moved, F.lit("item-hot")).otherwise(F.col(C.item)))
            .withColumn(C.location, F.when(moved, F.lit(1)).otherwise(F.col(C.location))))


def q_salted_hot_keys(spark, sf):
    rows = dedup_stage()(third_at_one_key(spark, sf))
    hot = hot_keys(rows, [C.location, C.item], HOT_REDUCERS)
    return count_by_hot_salted(rows, [C.location, C.item], hot, salt_from=[C.detection],
                               name=C.count)


def q_rank_items(spark, sf):
    return top_per_group(_counts(spark, sf), [C.location], C.count, C.item,
                         None, keep_count=True)


def q_rank_items_hot(spark, sf):
    """Every item ranked where one location has a third of all items."""
    li = adapters.table(spark, sf, "lineitem")
    rows = li.select(
        F.when(F.col("l_partkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey"))
        .alias(C.location), F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))
        .alias(C.item))
    return top_per_group(count_by(rows, [C.location, C.item], C.count), [C.location],
                         C.count, C.item, None, keep_count=True)


def q_topx_per_group(spark, sf):
    return top_per_group(_counts(spark, sf), [C.location], C.count, C.item,
                         TOP_X, keep_count=True)


def q_enrich_lookup(spark, sf):
    seen = _li(spark, sf).select(C.location).distinct()
    lookup = build_lookup(_sup(spark, sf), C.location, C.location_name)
    return enrich(seen, lookup, C.location, C.location_name)


def _as_text_key(df):
    return df.withColumn(C.location, F.concat(F.lit("loc-"), F.col(C.location).cast("string")))


def q_enrich_lookup_text_key(spark, sf):
    seen = _as_text_key(_ev(spark, sf).select(C.location).distinct())
    lookup = build_lookup(_as_text_key(_sup(spark, sf)), C.location, C.location_name)
    return enrich(seen, lookup, C.location, C.location_name)


def q_lookup_build(spark, sf):
    sup = adapters.table(spark, sf, "supplier")
    named = sup.select(F.col("s_suppkey").alias(C.location),
                       F.col("s_name").alias(C.location_name))
    renamed = sup.select(F.col("s_suppkey").alias(C.location),
                         F.concat_ws(" / ", "s_name", F.col("s_nationkey")
                                     .cast("string")).alias(C.location_name))
    return build_lookup(named.unionByName(renamed), C.location, C.location_name)


def q_key_skew(spark, sf):
    return key_skew_frame(_deduped(spark, sf), [C.location, C.item])


def q_location_skew(spark, sf):
    return key_skew_frame(_li(spark, sf), [C.location])


def q_partition_skew(spark, sf):
    dealt = _li(spark, sf).repartitionById(
        LAYOUT_PARTITIONS, (F.col(C.camera) % (LAYOUT_PARTITIONS - 1)).cast("int"))
    return partition_sizes(dealt, LAYOUT_PARTITIONS)


_METRICS_SCHEMA = StructType([
    StructField("stage_index", IntegerType(), False),
    StructField("stage", StringType(), False),
    StructField("rows_in", LongType(), True),
    StructField("rows_out", LongType(), True),
])


def q_stage_metrics(spark, sf):
    chain = top_items_stages(_sup(spark, sf), TOP_X)
    target = scratch_path(spark, "stage-metrics")
    _, metrics = chain.run(
        _li(spark, sf),
        lambda df: write(df, "parquet", target, dated=False, schema=OUTPUT))
    return spark.createDataFrame(metrics.table(), _METRICS_SCHEMA)


def q_compose_stages(spark, sf):
    return StageChain([dedup_stage(), count_stage(), top_stage(TOP_X_EVENTS)])(
        _li(spark, sf))


# --- sources and sinks --------------------------------------------------------

def q_scan_parquet(spark, sf):
    return read(spark, "PARQUET", f"{sf.rstrip('/')}/lineitem.parquet")


def q_read_rejects(spark, sf):
    """A CSV input of which some ids are no numbers: rows read and rejected."""
    broken = _li(spark, sf).withColumn(C.detection, F.concat(
        F.when(F.col(C.camera) == BAD_ID_LINE, F.lit("id-")).otherwise(F.lit("")),
        F.col(C.detection).cast("string")))
    target = write(broken, "csv", scratch_path(spark, "rejects"), dated=False)
    good, bad = split_rejects(read(spark, "csv", target, schema=DETECTIONS, malformed="reject"))
    return good.select(F.lit("read").alias("record")).unionByName(
        bad.select(F.lit("rejected").alias("record"))).groupBy("record") \
        .agg(F.count(F.lit(1)).alias("rows"))


def _odd(spark, sf):
    """The baseline's rows with values that formats are apt to lose."""
    end = F.element_at(F.array(*map(F.lit, ODD_ENDS)), F.col(C.rank))
    last = F.col(C.rank) == len(ODD_ENDS)
    return (_baseline(spark, sf)
            .withColumn(C.item, F.when(last, F.lit("\\N")).otherwise(F.concat(F.col(C.item), end)))
            .withColumn(C.location_name, F.when(last, F.lit("")).when(
                F.col(C.rank) > 1, F.col(C.location_name))))


def _roundtrip(spark, sf, fmt):
    target = write(_odd(spark, sf), fmt, scratch_path(spark, f"rt-{fmt}"),
                   run_date=RUN_DATE, schema=OUTPUT)
    return read(spark, fmt, target, schema=None if fmt == "txt" else OUTPUT,
                multiline=fmt == "csv")


def q_roundtrip_parquet(spark, sf):
    return _roundtrip(spark, sf, "parquet")


def q_roundtrip_csv(spark, sf):
    return _roundtrip(spark, sf, "csv")


def q_roundtrip_json(spark, sf):
    return _roundtrip(spark, sf, "json")


def q_roundtrip_text(spark, sf):
    return _roundtrip(spark, sf, "txt")


def q_sink_overwrite(spark, sf):
    base = scratch_path(spark, "overwrite")
    write(_baseline(spark, sf, TOP_X), "parquet", base, run_date=RUN_DATE)
    target = write(_baseline(spark, sf, TOP_X_EVENTS), "parquet", base,
                   run_date=RUN_DATE, mode="overwrite")
    return read(spark, "parquet", target, schema=OUTPUT)


def q_sink_errorifexists(spark, sf):
    """The first write succeeds, the second is refused, the first stays."""
    base, refused = scratch_path(spark, "once"), False
    target = write(_baseline(spark, sf), "parquet", base, mode="errorifexists", run_date=RUN_DATE)
    try:
        write(_baseline(spark, sf, TOP_X_EVENTS), "parquet", base, mode="errorifexists",
              run_date=RUN_DATE)
    except AnalysisException:
        refused = True
    return read(spark, "parquet", target, schema=OUTPUT).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"))


def q_sink_dated_path(spark, sf):
    """The four shapes of an output path, each written and read back."""
    root = scratch_path(spark, "dated")
    rows = _baseline(spark, sf)
    back = []
    for shape in ("a/", "b/result.parquet", "c/result"):
        target = write(rows, "parquet", f"{root}/{shape}", run_date=RUN_DATE, schema=OUTPUT)
        back.append((target[len(root) + 1:], target))
    bare = dated_output_path("output", RUN_DATE)
    back.append((bare, write(rows, "parquet", f"{root}/{bare}", dated=False, schema=OUTPUT)))
    return functools.reduce(DataFrame.unionByName, [
        read(spark, "parquet", target, schema=OUTPUT).withColumn("path", F.lit(path))
        for path, target in back])


def q_sink_run_date_column(spark, sf):
    """Two dates in one table; a second run of the first replaces that date alone."""
    base = scratch_path(spark, "run-dates")
    for top_x, day in ((TOP_X, RUN_DATE), (TOP_X_EVENTS, NEXT_DATE), (1, RUN_DATE)):
        target = write(_baseline(spark, sf, top_x), "parquet", base, run_date=day, schema=OUTPUT,
                       date_column="run_date")
    back = read(spark, "parquet", target)
    return back.select(*OUTPUT.fieldNames(), F.col("run_date").cast("string").alias("run_date"))


def q_sink_partitioned(spark, sf):
    target = write(_baseline(spark, sf), "parquet",
                   scratch_path(spark, "by-location"), run_date=RUN_DATE,
                   schema=OUTPUT, partition_by=[C.location])
    return read(spark, "parquet", target, schema=OUTPUT).select(*OUTPUT.fieldNames())


def q_sink_sized_files(spark, sf):
    """Locations share directories: as many files as buckets, not as locations."""
    target = write(_baseline(spark, sf), "parquet", scratch_path(spark, "by-bucket"),
                   run_date=RUN_DATE, schema=OUTPUT, partition_by=[C.location],
                   buckets=LOCATION_BUCKETS)
    return read(spark, "parquet", target, schema=OUTPUT).select(*OUTPUT.fieldNames())


def q_output_contract(spark, sf):
    return conform(_baseline(spark, sf), OUTPUT)


# --- null policies ------------------------------------------------------------

def _li_with_nulls(spark, sf):
    d = _li(spark, sf)
    return (d.withColumn(C.item, F.when(F.col(C.item) != NULL_ITEM, F.col(C.item)))
            .withColumn(C.detection, F.when(F.col(C.camera) != NULL_ID_LINE,
                                            F.col(C.detection))))


def q_null_policy_drop(spark, sf):
    return top_items(_li_with_nulls(spark, sf), _sup(spark, sf), TOP_X,
                     null_policy="drop")


def q_null_policy_fail(spark, sf):
    """The outcome of the guard as a row: whether it failed the job, and on what."""
    guarded = top_items(_li_with_nulls(spark, sf), _sup(spark, sf), TOP_X, null_policy="fail")
    try:
        guarded.write.format("noop").mode("overwrite").save()
        said = ""
    except Exception as error:  # noqa: BLE001 -- the failure is the result
        said = str(error)
    nulls = _li_with_nulls(spark, sf).filter(F.col(C.item).isNull() | F.col(C.detection).isNull())
    return nulls.agg(F.lit("null value in column" in said).alias("failed"),
                     F.count(F.lit(1)).alias("rows_with_nulls"))


def _broken_lines(spark, sf):
    """Detections as JSON lines of which some break the contract, by line number."""
    rows = _li_with_nulls(spark, sf)
    names, line = rows.columns, F.col(C.camera)

    def record(*left_out):
        return F.to_json(F.struct(*[c for c in names if c not in left_out]),
                         {"ignoreNullFields": "false"})
    return rows.select(
        F.when(line == CUT_LINE, F.substring(record(), 1, 40))
        .when(line == SHORT_LINE, record(C.timestamp, C.item))
        .otherwise(record()).alias("value"))


def _by_reason(spark, split):
    """Rows by reason, counted in the places that they were written to."""
    kept = split.kept(spark).select(F.lit("").alias("reason"))
    return kept.unionByName(split.quarantined(spark).select(F.col("_reason").alias("reason"))) \
        .groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def q_quarantine_json(spark, sf):
    base = scratch_path(spark, "quarantine-json")
    path = write(_broken_lines(spark, sf).toDF("value"), "txt", base + "/in", dated=False, text_sep="\t")
    split = write_split(read_checked(spark, "json", path, DETECTIONS), base + "/out", DETECTIONS)
    return _by_reason(spark, split)


def q_quarantine_csv(spark, sf):
    broken = _li_with_nulls(spark, sf).withColumn(C.detection, F.when(
        F.col(C.camera) == CUT_LINE, F.lit("no id")).otherwise(F.col(C.detection).cast("string")))
    base = scratch_path(spark, "quarantine-csv")
    path = write(broken, "csv", base + "/in", dated=False)
    split = write_split(read_checked(spark, "csv", path, DETECTIONS), base + "/out", DETECTIONS)
    return _by_reason(spark, split)


def q_job_run_quarantine(spark, sf):
    """The job on an input with broken rows: it goes on with the others."""
    base = scratch_path(spark, "job-quarantine")
    a = write(_li_with_nulls(spark, sf), "parquet", base + "/in/detections", dated=False)
    b = write(_sup(spark, sf), "parquet", base + "/in/locations", dated=False)
    run = run_top_items_job(spark, a, b, base + "/out/", TOP_X, run_date=RUN_DATE,
                            quarantine_path=base + "/quarantine")
    return read(spark, "parquet", run.output_path, schema=OUTPUT)


def q_null_policy_default(spark, sf):
    return top_items(_li_with_nulls(spark, sf), _sup(spark, sf), TOP_X,
                     null_policy="default")


QUERIES: dict[str, Query] = {
    "top_items_baseline": q_top_items_baseline,
    "top_items_skew_aware": q_top_items_skew_aware,
    "top_items_prepartitioned": q_top_items_prepartitioned,
    "top_items_events": q_top_items_events,
    "top_items_events_identical": q_top_items_events_identical,
    "top_items_events_skew_aware": q_top_items_events_skew_aware,
    "top_items_hot_key": q_top_items_hot_key,
    "skew_decision": q_skew_decision,
    "frequent_key_estimates": q_frequent_key_estimates,
    "jobs_equivalence": q_jobs_equivalence,
    "job_run_parquet": q_job_run_parquet,
    "job_run_csv_skew_aware": q_job_run_csv_skew_aware,
    "job_run_json_prepartitioned": q_job_run_json_prepartitioned,
    "dedup_keep_one": q_dedup_keep_one,
    "count_by_keys": q_count_by_keys,
    "count_by_keys_salted": q_count_by_keys_salted,
    "salted_hot_keys": q_salted_hot_keys,
    "rank_items": q_rank_items,
    "rank_items_hot": q_rank_items_hot,
    "topx_per_group": q_topx_per_group,
    "enrich_lookup": q_enrich_lookup,
    "enrich_lookup_text_key": q_enrich_lookup_text_key,
    "lookup_build": q_lookup_build,
    "key_skew": q_key_skew,
    "location_skew": q_location_skew,
    "partition_skew": q_partition_skew,
    "stage_metrics": q_stage_metrics,
    "compose_stages": q_compose_stages,
    "scan_parquet": q_scan_parquet,
    "read_rejects": q_read_rejects,
    "roundtrip_parquet": q_roundtrip_parquet,
    "roundtrip_csv": q_roundtrip_csv,
    "roundtrip_json": q_roundtrip_json,
    "roundtrip_text": q_roundtrip_text,
    "sink_overwrite": q_sink_overwrite,
    "sink_errorifexists": q_sink_errorifexists,
    "sink_dated_path": q_sink_dated_path,
    "sink_run_date_column": q_sink_run_date_column,
    "sink_partitioned": q_sink_partitioned,
    "sink_sized_files": q_sink_sized_files,
    "output_contract": q_output_contract,
    "null_policy_drop": q_null_policy_drop,
    "null_policy_default": q_null_policy_default,
    "null_policy_fail": q_null_policy_fail,
    "quarantine_json": q_quarantine_json,
    "quarantine_csv": q_quarantine_csv,
    "job_run_quarantine": q_job_run_quarantine,
}
