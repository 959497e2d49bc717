"""JSON under a contract in one scan, quarantined rows, run dates as a column."""
import pytest

from conftest import detections, locations, physical_plan, tuples
from rankwise.contracts import DETECTIONS, LOCATIONS
from rankwise.plans.jobs import run_top_items_job, top_items
from rankwise.session import scratch_path
from rankwise.sources import read, read_checked, split_rejects, write, write_split

GOOD = '{"geographical_location_oid":1,"geographical_location":"a"}'


def lines(spark, *texts):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    return path


def locs(df):
    return tuples(df.select("geographical_location_oid", "geographical_location"))


def test_json_is_read_in_one_scan(spark):
    path = lines(spark, GOOD)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("json-build", "json-build")
    try:
        df = read(spark, "json", path, schema=LOCATIONS)
        assert list(tracker.getJobIdsForGroup("json-build")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    plan = physical_plan(df)
    assert plan.count("FileScan") == 1 and plan.count("from_json") == 1
    assert locs(df) == [(1, "a")]


def test_a_json_record_without_a_required_name_is_malformed(spark):
    short = '{"geographical_location":"b"}'
    path = lines(spark, GOOD, short, "", "  ")
    with pytest.raises(Exception, match="missing columns in a record: geographical_location_oid"):
        read(spark, "json", path, schema=LOCATIONS).select("geographical_location").collect()
    assert locs(read(spark, "json", path, schema=LOCATIONS, malformed="null")) == [(1, "a"), (None, "b")]
    good, bad = split_rejects(read(spark, "json", path, schema=LOCATIONS, malformed="reject"))
    assert locs(good) == [(1, "a")] and [r[0] for r in bad.collect()] == [short]


def test_a_null_written_out_is_a_null(spark):
    rows = locations(spark, [(None, "x"), (2, None)])
    path = write(rows, "json", scratch_path(spark, "nulls"), dated=False)
    assert locs(read(spark, "json", path, schema=LOCATIONS)) == [(2, None), (None, "x")]


def test_json_of_no_records_is_empty(spark):
    assert read(spark, "json", lines(spark, ""), schema=LOCATIONS).collect() == []


def checked(spark, fmt, path, schema=LOCATIONS):
    rows = read_checked(spark, fmt, path, schema)
    split = write_split(rows, scratch_path(spark, "split"), schema)
    bad = {(r["_reason"], r["_record"]) for r in split.quarantined(spark).collect()}
    assert split.kept(spark).columns == schema.fieldNames()
    assert sum(split.reasons.values()) == split.quarantined(spark).count()
    assert split.kept_rows == split.kept(spark).count()
    return locs(split.kept(spark)) if schema is LOCATIONS else None, bad, split.reasons


def test_every_json_reason(spark):
    cut, short = '{"geographical_location_oid":', '{"geographical_location":"b"}'
    text = '{"geographical_location_oid":"no","geographical_location":"c"}'
    null = '{"geographical_location_oid":null,"geographical_location":null}'
    kept, bad, counts = checked(spark, "json", lines(spark, GOOD, cut, short, text, null, null))
    assert kept == [(1, "a")]
    assert bad == {("malformed record", cut), ("malformed record", text),
                   ("missing geographical_location_oid", short),
                   ("null geographical_location_oid", None)}
    assert counts == {"malformed record": 2, "missing geographical_location_oid": 1,
                      "null geographical_location_oid": 2}


def test_every_csv_reason(spark):
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("4", None)],
                                 "geographical_location_oid string, geographical_location string")
    path = write(rows, "csv", scratch_path(spark, "csv"), dated=False)
    kept, bad, counts = checked(spark, "csv", path)
    assert kept == [(1, "a")]
    assert {r for r, _ in bad} == {"malformed record", "null geographical_location_oid",
                                   "null geographical_location"} and sum(counts.values()) == 3


def test_every_parquet_reason(spark):
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")],
                                 "geographical_location_oid string, geographical_location string")
    path = write(rows, "parquet", scratch_path(spark, "pq"), dated=False)
    kept, bad, _ = checked(spark, "parquet", path)
    assert kept == [(1, "a")]
    assert bad == {("unreadable geographical_location_oid", None),
                   ("null geographical_location_oid", None)}
    with pytest.raises(ValueError, match="missing columns"):
        read_checked(spark, "parquet", path, DETECTIONS)
    with pytest.raises(ValueError, match="no columns"):
        read_checked(spark, "txt", path, LOCATIONS)


@pytest.mark.parametrize("keep", [True, False])
def test_a_place_without_rows_is_empty(spark, keep):
    rows = locations(spark, [(1, "a")] if keep else [])
    path = write(rows, "parquet", scratch_path(spark, "one"), dated=False)
    kept, bad, counts = checked(spark, "parquet", path)
    assert (kept, bad, counts) == ([(1, "a")] if keep else [], set(), {})


def test_the_job_goes_on_with_rows_that_keep_the_contract(spark):
    rows = [(1, 1, i, "apple", 5) for i in range(4)] + [(1, 1, None, "pear", 5), (2, 1, 9, None, 5)]
    names = [(1, "one"), (2, None)]
    base = scratch_path(spark, "job")
    a = write(detections(spark, rows), "json", base + "/a", dated=False)
    b = write(locations(spark, names), "json", base + "/b", dated=False)
    run = run_top_items_job(spark, a, b, base + "/out", 3, input_format="json",
                            quarantine_path=base + "/q")
    assert run.rejected == {"detections": 2, "locations": 1}
    assert run.splits["detections"].reasons == {"null detection_oid": 1, "null item_name": 1}
    want = top_items(detections(spark, rows[:4]), locations(spark, names[:1]), 3)
    assert tuples(read(spark, "parquet", run.output_path)) == tuples(want)


def test_a_second_run_of_a_date_replaces_that_date_alone(spark):
    base = scratch_path(spark, "dates")
    for rows, day in (([(1, "a")], "2026-01-01"), ([(2, "b")], "2026-01-02"),
                      ([(3, "c"), (4, "d")], "2026-01-01")):
        target = write(locations(spark, rows), "parquet", base, run_date=day, schema=LOCATIONS,
                       date_column="run_date")
        assert target == base
    back = read(spark, "parquet", base).selectExpr("geographical_location_oid", "string(run_date)")
    assert tuples(back) == [(2, "2026-01-02"), (3, "2026-01-01"), (4, "2026-01-01")]
    with pytest.raises(ValueError, match="already"):
        write(locations(spark, [(1, "a")]), "parquet", base, date_column="geographical_location")


@pytest.mark.parametrize("fmt", ["txt", "json", "csv"])
def test_date_columns_of_other_formats(spark, fmt):
    base = scratch_path(spark, "dates")
    write(locations(spark, [(1, "a")]), fmt, base, run_date="2026-01-01", date_column="day")
    [row] = read(spark, fmt, base).collect()
    assert str(row["day"]) == "2026-01-01"
    assert fmt != "txt" or row["value"] == "1,a"


def test_the_job_writes_a_date_column(spark):
    rows = [(1, 1, 1, "apple", 5)]
    base = scratch_path(spark, "job-dates")
    a = write(detections(spark, rows), "parquet", base + "/a", dated=False)
    b = write(locations(spark, [(1, "one")]), "parquet", base + "/b", dated=False)
    run = run_top_items_job(spark, a, b, base + "/out", 3, run_date="2026-04-21",
                            date_column="run_date")
    assert run.output_path == base + "/out"
    [row] = read(spark, "parquet", base + "/out").collect()
    assert str(row["run_date"]) == "2026-04-21" and row["item_name"] == "apple"
