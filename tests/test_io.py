"""Sources, sinks, format names, dated paths and the output contract."""
import datetime as dt
import os

import pytest

from conftest import tuples
from rankwise.contracts import OUTPUT, conform
from rankwise.session import remove_path, scratch_path, shared_dir
from rankwise.sources import dated_output_path, read, resolve_format, write

DAY = "2026-04-21"


@pytest.mark.parametrize("base, expected", [
    ("data/output/", "data/output/2026-04-21"),
    ("data/output/result.parquet", "data/output/2026-04-21/result.parquet"),
    ("data/output/result", "data/output/result/2026-04-21"),
    ("output", "output/2026-04-21"),
    ("data\\output\\result.parquet", "data\\output\\2026-04-21\\result.parquet"),
    ("data\\output\\", "data\\output\\2026-04-21"),
    ("data/.hidden", "data/.hidden/2026-04-21"),
    ("data/name.", "data/name./2026-04-21"),
    ("result.parquet", "2026-04-21/result.parquet"),
])
def test_dated_paths(base, expected):
    assert dated_output_path(base, DAY) == expected


def test_dated_path_rejects_empty_base():
    for base in ("", "   "):
        with pytest.raises(ValueError):
            dated_output_path(base, DAY)


def test_dated_path_accepts_date_and_defaults_to_today():
    assert dated_output_path("out/", dt.date(2026, 4, 21)) == "out/2026-04-21"
    assert dated_output_path("out/").endswith(dt.date.today().isoformat())


def test_format_names():
    assert resolve_format("PARQUET") == "parquet"
    assert resolve_format("txt") == "text"
    for bad in ("bogus", "avro", ""):
        with pytest.raises(ValueError, match="Unsupported format"):
            resolve_format(bad)


def test_read_and_write_reject_unknown_format(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        read(spark, "bogus", "/nowhere")
    with pytest.raises(ValueError):
        write(df, "bogus", "/nowhere")
    with pytest.raises(ValueError):
        write(df, "parquet", "/nowhere", mode="sometimes")


class _Cluster:
    """As much of a session as ``shared_dir`` looks at."""

    def __init__(self, master, conf=None, folder=None):
        self.sparkContext = self
        self.master, self.applicationId = master, "app-1"
        self._conf, self._folder = conf or {}, folder

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._folder


def test_shared_dir_comes_from_session(spark):
    base = shared_dir(spark)
    assert base == shared_dir(spark)
    app = spark.sparkContext.applicationId
    assert scratch_path(spark, "x").startswith(f"{base}/rankwise/{app}/x-")


def test_shared_dir_is_never_local_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_Cluster(master))
        assert shared_dir(_Cluster(master, {"spark.checkpoint.dir": "hdfs:/c/"})) == "hdfs:/c"
        assert shared_dir(_Cluster(master, folder="hdfs:/d")) == "hdfs:/d"
    local = _Cluster("local[4]")
    assert shared_dir(local) == shared_dir(local) and local.getCheckpointDir() is None


def test_scratch_paths_can_be_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


TRICKY = [
    (1, "Alpha", 1, "apple"),
    (2, None, 1, "null name"),
    (3, "", 1, "empty name"),
    (4, "  spaced  ", 1, "a,b"),
    (5, 'quote "q"', 2, "line\nbreak"),
    (6, "back\\slash", 1, "\\N literal"),
    (7, "\\N", 1, "\\N"),
    (8, "\\\\N", 1, "\\"),
]


def _output_rows(spark):
    return spark.createDataFrame(
        TRICKY, "geographical_location_oid long, geographical_location string, "
                "item_rank int, item_name string")


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_roundtrip_keeps_values(spark, fmt):
    target = write(_output_rows(spark), fmt, scratch_path(spark, fmt) + "/",
                   run_date=DAY, schema=OUTPUT)
    assert target.endswith(DAY)
    back = read(spark, fmt, target, schema=OUTPUT, multiline=(fmt == "csv"))
    assert tuples(back) == sorted(TRICKY, key=repr)


def test_roundtrip_csv_without_multiline_for_plain_values(spark):
    plain = [r for r in TRICKY if "\n" not in r[3]]
    df = _output_rows(spark).filter("item_name NOT LIKE '%\n%'")
    target = write(df, "csv", scratch_path(spark, "csv-plain"), dated=False)
    assert tuples(read(spark, "csv", target, schema=OUTPUT)) == sorted(plain, key=repr)


def test_csv_without_schema_reads_strings_with_header(spark):
    target = write(_output_rows(spark).limit(1), "csv", scratch_path(spark, "csvs"),
                   dated=False)
    back = read(spark, "csv", target, multiline=True)
    assert back.columns == OUTPUT.fieldNames()
    assert {t for _, t in back.dtypes} == {"string"}


def test_csv_with_reordered_columns_is_refused_not_misread(spark):
    df = _output_rows(spark).limit(1).select("item_name", "item_rank",
                                              "geographical_location",
                                              "geographical_location_oid")
    target = write(df, "csv", scratch_path(spark, "csv-order"), dated=False)
    with pytest.raises(Exception, match="(?i)header|schema"):
        read(spark, "csv", target, schema=OUTPUT).collect()


def test_text_sink_renders_lines_and_overwrites(spark):
    base = scratch_path(spark, "text")
    write(_output_rows(spark), "txt", base, run_date=DAY)
    target = write(_output_rows(spark).filter("geographical_location_oid <= 2"),
                   "txt", base, run_date=DAY, mode="overwrite")
    lines = sorted(r.value for r in read(spark, "txt", target).collect())
    assert lines == ["1,Alpha,1,apple", "2,\\N,1,null name"]


def test_errorifexists_refuses_existing_path(spark):
    base = scratch_path(spark, "exists")
    write(spark.range(2), "parquet", base, dated=False)
    with pytest.raises(Exception):
        write(spark.range(2), "parquet", base, dated=False, mode="errorifexists")


def test_partitioned_sink_roundtrip(spark):
    target = write(_output_rows(spark), "parquet", scratch_path(spark, "part"),
                   dated=False, schema=OUTPUT,
                   partition_by=["geographical_location_oid"])
    assert any(n.startswith("geographical_location_oid=")
               for n in os.listdir(target.replace("file:", "")))
    back = read(spark, "parquet", target, schema=OUTPUT)
    assert tuples(back.select(*OUTPUT.fieldNames())) == sorted(TRICKY, key=repr)


def test_conform_orders_casts_and_checks(spark):
    df = spark.createDataFrame([("apple", 1, "Alpha", 7)],
                               "item_name string, item_rank long, "
                               "geographical_location string, geographical_location_oid int")
    out = conform(df, OUTPUT)
    assert out.columns == OUTPUT.fieldNames()
    assert [t for _, t in out.dtypes] == ["bigint", "string", "int", "string"]
    bad = spark.createDataFrame([(None, "x", 1, "a")],
                                "geographical_location_oid long, geographical_location string, "
                                "item_rank int, item_name string")
    with pytest.raises(Exception, match="non-nullable"):
        conform(bad, OUTPUT).collect()
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("item_name"), OUTPUT)


def test_append_mode_accumulates(spark):
    base = scratch_path(spark, "append")
    write(spark.range(3), "parquet", base, dated=False)
    write(spark.range(2), "parquet", base, dated=False, mode="append")
    assert read(spark, "parquet", base).count() == 5


def test_json_without_schema_infers_by_name(spark):
    target = write(_output_rows(spark), "json", scratch_path(spark, "json-infer"),
                   dated=False)
    back = read(spark, "json", target)
    assert sorted(back.columns) == sorted(OUTPUT.fieldNames())
    assert tuples(back.select(*OUTPUT.fieldNames())) == sorted(TRICKY, key=repr)


def test_text_sink_partitioned(spark):
    target = write(_output_rows(spark).filter("geographical_location_oid <= 2"), "txt",
                   scratch_path(spark, "text-part"), dated=False,
                   partition_by=["geographical_location_oid"])
    back = read(spark, "txt", target)
    assert sorted((r.geographical_location_oid, r.value) for r in back.collect()) == [
        (1, "Alpha,1,apple"), (2, "\\N,1,null name")]
