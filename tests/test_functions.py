"""Column helpers and the lookup size measure."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankwise.functions import NULL_TOKEN, not_null, salt_bucket, split_line, text_line
from rankwise.operators import lookup_size
from rankwise.operators.lookup import ROW_OVERHEAD
from rankwise.sources import run_date_text


def test_salt_bucket_is_deterministic_and_in_range(spark):
    df = spark.range(1000)
    salted = df.select("id", salt_bucket(["id"], 7).alias("s"))
    first = {r.id: r.s for r in salted.collect()}
    again = {r.id: r.s for r in salted.collect()}
    assert first == again
    assert set(first.values()) == set(range(7))
    with pytest.raises(ValueError):
        salt_bucket(["id"], 0)


def test_text_line_keeps_field_positions_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "b", None)], "a long, b string, c string")
    lines = sorted(r.v for r in df.select(text_line(df.columns, "|").alias("v")).collect())
    assert lines == sorted([f"1|{NULL_TOKEN}|x", f"{NULL_TOKEN}|b|{NULL_TOKEN}"])


def test_not_null_passes_values_and_fails_on_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "a long")
    assert [r.a for r in df.select(not_null(F.col("a"), "boom").alias("a")).collect()] == [1, 2]
    bad = spark.createDataFrame([(None,)], "a long")
    with pytest.raises(Exception, match="boom"):
        bad.select(not_null(F.col("a"), "boom").alias("a")).collect()


def test_text_lines_lose_no_value(spark):
    values = ["x", "", "a,b", "a\\,b", "x\ny", "\r", "\\N", "\\", "\\\\n", "\\n", "n\\", None, ",", "é|"]
    rows = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(rows, "a string, b string")
    for sep in (",", "|", "\t"):
        lines = df.select(text_line(df.columns, sep).alias("v"))
        assert not lines.filter("v like '%\n%' or v like '%\r%'").count()
        back = [tuple(r[0]) for r in lines.select(split_line(F.col("v"), sep)).collect()]
        assert back == rows
    with pytest.raises(ValueError):
        text_line(["a"], "n")


def test_lookup_size_counts_keys_values_and_rows(spark):
    lk = spark.createDataFrame([(1, "ab"), (2, None), (3, "é")], "k long, v string")
    rows, size = lookup_size(lk, "k", "v")
    assert rows == 3 and size == 3 * ROW_OVERHEAD + 2 * 3 + 2 + 2    # 'é' is two bytes
    assert lookup_size(spark.createDataFrame([], "k long, v string"), "k", "v") == (0, 0)
    text = spark.createDataFrame([("k" * 500, "v")] * 10, "k string, v string")
    assert lookup_size(text, "k", "v")[1] >= 10 * 500


def test_run_date_text():
    assert run_date_text("2026-04-21") == "2026-04-21"
    assert run_date_text(dt.date(2026, 4, 21)) == "2026-04-21"
    assert run_date_text() == dt.date.today().isoformat()
    for bad in ("not/a/date", "2026-4-1", "2026-02-30", "20260421", "", dt.datetime(2026, 4, 21, 10),
                20260421):
        with pytest.raises(ValueError):
            run_date_text(bad)
