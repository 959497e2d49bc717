"""Operator-level tests on small hand-made inputs."""
import pytest

from conftest import detections, locations, tuples
from rankwise.operators import (apply_null_policy, build_lookup, count_by,
                                count_by_salted, dedup_keep_one, enrich,
                                top_per_group)

ORDER = ["timestamp_detected", "geographical_location_oid", "video_camera_oid",
         "item_name"]


# --- dedup ----------------------------------------------------------------------

def test_dedup_keeps_one_row_per_id(spark):
    df = detections(spark, [(1, 1, i, "x", 1) for i in (100, 100, 101, 102, 102)])
    out = dedup_keep_one(df, "detection_oid", ORDER)
    assert tuples(out, "detection_oid") == [(100,), (101,), (102,)]


def test_dedup_empty_input(spark):
    df = detections(spark, [])
    assert dedup_keep_one(df, "detection_oid", ORDER).count() == 0


def test_dedup_identical_rows_collapse(spark):
    df = detections(spark, [(1, 10, 7, "apple", 5)] * 5)
    assert tuples(dedup_keep_one(df, "detection_oid", ORDER)) == [(1, 10, 7, "apple", 5)]


def test_dedup_conflicting_rows_pick_earliest_then_smallest(spark):
    df = detections(spark, [
        (2, 10, 7, "pear", 9),
        (1, 11, 7, "zebra", 3),     # earliest timestamp wins
        (1, 10, 7, "apple", 4),
        (5, 1, 8, "b", 1),
        (5, 1, 8, "a", 1),          # same ts/location/camera: item breaks the tie
    ])
    out = dedup_keep_one(df, "detection_oid", ORDER)
    assert tuples(out) == [(1, 11, 7, "zebra", 3), (5, 1, 8, "a", 1)]


def test_dedup_null_id_is_one_key(spark):
    df = detections(spark, [(1, 1, None, "a", 1), (1, 1, None, "b", 2), (1, 1, 3, "c", 1)])
    out = dedup_keep_one(df, "detection_oid", ORDER)
    assert tuples(out, "detection_oid", "item_name") == [(3, "c"), (None, "a")]


def test_dedup_keeps_column_order(spark):
    df = detections(spark, [(1, 1, 1, "a", 1)])
    assert dedup_keep_one(df, "detection_oid", ORDER).columns == df.columns


def test_dedup_fast_path_for_identical_copies(spark):
    df = detections(spark, [(1, 10, 7, "apple", 5)] * 3 + [(2, 10, 8, "pear", 5)])
    out = dedup_keep_one(df, "detection_oid", assume_identical=True)
    assert tuples(out, "detection_oid") == [(7,), (8,)]


def test_dedup_unknown_key(spark):
    with pytest.raises(ValueError):
        dedup_keep_one(detections(spark, []), "nope")


# --- counting -------------------------------------------------------------------

def _count_input(spark):
    return detections(spark, [(1, 1, 1, "apple", 1), (1, 1, 2, "apple", 1),
                              (1, 1, 3, "banana", 1), (2, 1, 4, "apple", 1)])


def test_count_by_composite_key(spark):
    out = count_by(_count_input(spark), ["geographical_location_oid", "item_name"], "n")
    assert tuples(out) == [(1, "apple", 2), (1, "banana", 1), (2, "apple", 1)]


def test_count_single_row(spark):
    df = detections(spark, [(1, 1, 1, "apple", 1)])
    assert tuples(count_by(df, ["item_name"], "n")) == [("apple", 1)]


def test_salted_count_matches_plain(spark):
    df = detections(spark, [(1, 1, i, "apple", 1) for i in range(3)]
                    + [(1, 1, 9, "banana", 1), (2, 1, 10, "apple", 1)])
    keys = ["geographical_location_oid", "item_name"]
    out = count_by_salted(df, keys, 4, salt_from=["detection_oid"], name="n")
    assert tuples(out) == [(1, "apple", 3), (1, "banana", 1), (2, "apple", 1)]
    assert dict(out.dtypes)["n"] == "bigint"


def test_salted_count_hot_key(spark):
    df = detections(spark, [(1, 1, i, "hot", 1) for i in range(50)])
    out = count_by_salted(df, ["item_name"], 8, salt_from=["detection_oid"], name="n")
    assert tuples(out) == [("hot", 50)]


def test_salted_count_one_row_and_bad_salts(spark):
    df = detections(spark, [(1, 1, 1, "x", 1)])
    assert tuples(count_by_salted(df, ["item_name"], 2, name="n")) == [("x", 1)]
    with pytest.raises(ValueError):
        count_by_salted(df, ["item_name"], 0)


# --- ranking --------------------------------------------------------------------

def _counts(spark, rows):
    return spark.createDataFrame(rows, "g long, item string, n long")


def _top(df, x):
    return [(r["item"]) for r in
            top_per_group(df, ["g"], "n", "item", x).orderBy("g", "item_rank").collect()]


def test_rank_by_count_desc(spark):
    df = _counts(spark, [(1, "apple", 5), (1, "banana", 10), (1, "cherry", 1)])
    assert _top(df, 3) == ["banana", "apple", "cherry"]


def test_rank_ties_alphabetical(spark):
    df = _counts(spark, [(1, "banana", 5), (1, "apple", 5), (1, "cherry", 5)])
    out = top_per_group(df, ["g"], "n", "item", 3)
    assert tuples(out, "item_rank", "item") == [(1, "apple"), (2, "banana"), (3, "cherry")]


def test_rank_truncates(spark):
    df = _counts(spark, [(1, "a", 4), (1, "b", 3), (1, "c", 2), (1, "d", 1)])
    assert _top(df, 2) == ["a", "b"]


def test_rank_groups_separately(spark):
    df = _counts(spark, [(1, "a", 2), (1, "b", 1), (2, "x", 10)])
    out = top_per_group(df, ["g"], "n", "item", 5)
    assert tuples(out) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "x")]
    assert dict(out.dtypes)["item_rank"] == "int"


def test_rank_zero_and_negative(spark):
    df = _counts(spark, [(1, "a", 2)])
    assert top_per_group(df, ["g"], "n", "item", 0).count() == 0
    with pytest.raises(ValueError):
        top_per_group(df, ["g"], "n", "item", -1)


def test_rank_all_keeps_count(spark):
    df = _counts(spark, [(1, "a", 2), (1, "b", 3)])
    out = top_per_group(df, ["g"], "n", "item", None, keep_count=True)
    assert tuples(out) == [(1, 1, "b", 3), (1, 2, "a", 2)]


# --- lookup ---------------------------------------------------------------------

def test_enrich_inserts_name_second(spark):
    df = spark.createDataFrame([(1, 1, "apple"), (2, 1, "banana")],
                               "geographical_location_oid long, item_rank int, item_name string")
    lk = locations(spark, [(1, "Alpha"), (2, "Beta")])
    out = enrich(df, lk, "geographical_location_oid", "geographical_location")
    assert out.columns == ["geographical_location_oid", "geographical_location",
                           "item_rank", "item_name"]
    assert tuples(out) == [(1, "Alpha", 1, "apple"), (2, "Beta", 1, "banana")]


def test_enrich_missing_key_gives_null(spark):
    df = spark.createDataFrame([(99, 1, "x")],
                               "geographical_location_oid long, item_rank int, item_name string")
    out = enrich(df, locations(spark, [(1, "Alpha")]), "geographical_location_oid",
                 "geographical_location")
    assert tuples(out) == [(99, None, 1, "x")]


def test_enrich_null_key_matches_null(spark):
    df = spark.createDataFrame([(None, 1, "x")],
                               "geographical_location_oid long, item_rank int, item_name string")
    out = enrich(df, locations(spark, [(None, "Nowhere"), (1, "Alpha")]),
                 "geographical_location_oid", "geographical_location")
    assert tuples(out) == [(None, "Nowhere", 1, "x")]


def test_enrich_without_broadcast_gives_same_rows(spark):
    df = spark.createDataFrame([(1, 1, "a"), (3, 1, "b")],
                               "geographical_location_oid long, item_rank int, item_name string")
    lk = locations(spark, [(1, "Alpha")])
    out = enrich(df, lk, "geographical_location_oid", "geographical_location",
                 broadcast_limit=0)
    assert tuples(out) == [(1, "Alpha", 1, "a"), (3, None, 1, "b")]


def test_build_lookup_duplicate_keys_no_fanout(spark):
    lk = build_lookup(locations(spark, [(1, "Alpha"), (1, "Zulu"), (2, "Beta")]),
                      "geographical_location_oid", "geographical_location")
    assert tuples(lk) == [(1, "Zulu"), (2, "Beta")]
    df = spark.createDataFrame([(1, 1, "a")],
                               "geographical_location_oid long, item_rank int, item_name string")
    out = enrich(df, lk, "geographical_location_oid", "geographical_location")
    assert out.count() == 1


# --- null policies -------------------------------------------------------------

def _with_nulls(spark):
    return detections(spark, [(1, 1, 1, "a", 1), (1, 1, None, "b", 1),
                              (1, 1, 3, None, 1)])


def test_null_policy_drop(spark):
    out = apply_null_policy(_with_nulls(spark), "drop", id_col="detection_oid",
                            item_col="item_name")
    assert tuples(out, "detection_oid") == [(1,)]


def test_null_policy_default(spark):
    out = apply_null_policy(_with_nulls(spark), "default", id_col="detection_oid",
                            item_col="item_name")
    assert tuples(out, "item_name") == [("a",), ("b",), ("unknown",)]


def test_null_policy_keep(spark):
    df = _with_nulls(spark)
    assert apply_null_policy(df, "keep", id_col="detection_oid",
                             item_col="item_name").count() == 3


def test_null_policy_fail(spark):
    out = apply_null_policy(_with_nulls(spark), "FAIL", id_col="detection_oid",
                            item_col="item_name")
    with pytest.raises(Exception, match="null value in column"):
        out.collect()


def test_null_policy_unknown(spark):
    with pytest.raises(ValueError):
        apply_null_policy(_with_nulls(spark), "ignore", id_col="detection_oid",
                          item_col="item_name")


def test_lookup_with_numeric_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, item string")
    lk = spark.createDataFrame([(1, 10), (1, 30), (2, 20)], "k long, score long")
    out = enrich(df, build_lookup(lk, "k", "score"), "k", "score")
    assert tuples(out) == [(1, 30, "a"), (2, 20, "b")]
