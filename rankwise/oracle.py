"""Independent DuckDB SQL for every registered query that SQL can express.

Written against the raw test tables (views ``lineitem``, ``supplier`` and
``events``). Column names and types follow the Spark side:
ranks are INTEGER, counts BIGINT.
"""
from __future__ import annotations

from rankwise.catalog import (BAD_ID_LINE, CUT_LINE, HOT_REDUCERS, LAYOUT_PARTITIONS, NEXT_DATE,
                              NULL_ID_LINE, NULL_ITEM, RUN_DATE, SHORT_LINE, TOP_X, TOP_X_EVENTS)

_LINEITEM_DETECTIONS = """
    SELECT l_suppkey AS geographical_location_oid,
           CAST(l_linenumber AS BIGINT) AS video_camera_oid,
           l_orderkey * 10 + l_linenumber AS detection_oid,
           'item-' || CAST(l_partkey % 40 AS VARCHAR) AS item_name,
           epoch_us(l_shipdate) AS timestamp_detected
    FROM lineitem"""

_EVENT_ONCE = """
    SELECT user_id AS geographical_location_oid,
           event_id % 16 AS video_camera_oid,
           event_id AS detection_oid,
           event_type AS item_name,
           epoch_us(ts) AS timestamp_detected
    FROM events"""

_EVENT_DETECTIONS = f"{_EVENT_ONCE} UNION ALL {_EVENT_ONCE}"

_SUPPLIER_LOCATIONS = """
    SELECT s_suppkey AS geographical_location_oid,
           s_name AS geographical_location
    FROM supplier"""

_LINEITEM_WITH_NULLS = f"""
    SELECT geographical_location_oid, video_camera_oid,
           CASE WHEN video_camera_oid <> {NULL_ID_LINE} THEN detection_oid END
               AS detection_oid,
           CASE WHEN item_name <> '{NULL_ITEM}' THEN item_name END AS item_name,
           timestamp_detected
    FROM ({_LINEITEM_DETECTIONS})"""


def _chain(detections: str, locations: str, top_x: int | None) -> str:
    """CTEs d (input), w (deduped), a (counts), r (ranked), loc, top."""
    keep = f"WHERE item_rank <= {top_x}" if top_x is not None else ""
    return f"""
    WITH d AS ({detections}),
    w AS (
        SELECT * FROM d
        QUALIFY row_number() OVER (
            PARTITION BY detection_oid
            ORDER BY timestamp_detected, geographical_location_oid,
                     video_camera_oid, item_name) = 1),
    a AS (
        SELECT geographical_location_oid, item_name, count(*) AS item_count
        FROM w GROUP BY geographical_location_oid, item_name),
    r AS (
        SELECT geographical_location_oid, item_name, item_count,
               CAST(row_number() OVER (
                   PARTITION BY geographical_location_oid
                   ORDER BY item_count DESC, item_name) AS INTEGER) AS item_rank
        FROM a),
    loc AS (
        SELECT geographical_location_oid,
               max(geographical_location) AS geographical_location
        FROM ({locations}) GROUP BY geographical_location_oid),
    top AS (
        SELECT r.geographical_location_oid, loc.geographical_location,
               r.item_rank, r.item_name
        FROM r LEFT JOIN loc
          ON r.geographical_location_oid IS NOT DISTINCT FROM
             loc.geographical_location_oid
        {keep})"""


def _top(detections, locations, top_x) -> str:
    return _chain(detections, locations, top_x) + " SELECT * FROM top"


_LI = _chain(_LINEITEM_DETECTIONS, _SUPPLIER_LOCATIONS, TOP_X)
BASELINE = _LI + " SELECT * FROM top"
# A third of the detections moved to one key.
_HOT_DETECTIONS = f"""
    SELECT CASE WHEN detection_oid % 3 = 0 THEN 1 ELSE geographical_location_oid END
               AS geographical_location_oid, video_camera_oid, detection_oid,
           CASE WHEN detection_oid % 3 = 0 THEN 'item-hot' ELSE item_name END AS item_name,
           timestamp_detected FROM ({_LINEITEM_DETECTIONS})"""
_HOT = _chain(_HOT_DETECTIONS, _SUPPLIER_LOCATIONS, TOP_X)
_ODD = _LI + r""", odd AS (
    SELECT geographical_location_oid,
           CASE WHEN item_rank = 5 THEN '' WHEN item_rank > 1 THEN geographical_location END
               AS geographical_location, item_rank,
           CASE item_rank WHEN 1 THEN item_name || ',x' WHEN 2 THEN item_name || chr(10) || 'y'
               WHEN 3 THEN item_name || '"z"' WHEN 4 THEN item_name || '\w' ELSE '\N' END
               AS item_name
    FROM top)"""


def _escape(column: str) -> str:
    out = f"CAST({column} AS VARCHAR)"
    for plain, escaped in (("'\\'", "'\\\\'"), ("','", "'\\,'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'")):
        out = f"replace({out}, {plain}, {escaped})"
    return f"coalesce({out}, '\\N')"


_TEXT_LINE = " || ',' || ".join(map(_escape, (
    "geographical_location_oid", "geographical_location", "item_rank", "item_name")))


def _skew(frame_sql: str) -> str:
    return f"""
    SELECT count(*) AS keys,
           CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows,
           CAST(coalesce(max(rows), 0) AS BIGINT) AS largest,
           CASE WHEN coalesce(sum(rows), 0) > 0
                THEN CAST(max(rows) * count(*) AS DOUBLE) / CAST(sum(rows) AS DOUBLE)
                ELSE 0.0 END AS skew_factor
    FROM ({frame_sql})"""


ORACLE: dict[str, str] = {
    "top_items_baseline": BASELINE,
    "top_items_skew_aware": BASELINE,
    "top_items_prepartitioned": BASELINE,
    "top_items_events": _top(_EVENT_DETECTIONS, _SUPPLIER_LOCATIONS, TOP_X_EVENTS),
    "top_items_events_identical": _top(_EVENT_DETECTIONS, _SUPPLIER_LOCATIONS,
                                       TOP_X_EVENTS),
    "top_items_events_skew_aware": _top(_EVENT_DETECTIONS, _SUPPLIER_LOCATIONS,
                                        TOP_X_EVENTS),
    "job_run_parquet": BASELINE,
    "job_run_csv_skew_aware": BASELINE,
    "job_run_json_prepartitioned": BASELINE,
    "top_items_hot_key": _HOT + " SELECT * FROM top",
    "skew_decision": f"""
        SELECT geographical_location_oid, item_name,
               CAST(greatest(2, ceil(n * {HOT_REDUCERS} / total)) AS BIGINT) AS salts
        FROM (SELECT geographical_location_oid, item_name, count(*) AS n,
                     sum(count(*)) OVER () AS total
              FROM ({_HOT_DETECTIONS}) GROUP BY ALL)
        WHERE n * {HOT_REDUCERS} > total""",
    "frequent_key_estimates": f"""
        SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (WHERE hot) AS hot_keys,
               count(*) FILTER (WHERE hot) AS hot_keys_named, CAST(0 AS BIGINT) AS out_of_bounds
        FROM (SELECT count(*) AS n, count(*) * {HOT_REDUCERS} > sum(count(*)) OVER () AS hot
              FROM ({_HOT_DETECTIONS}) GROUP BY geographical_location_oid, item_name)""",
    "jobs_equivalence": _HOT + """
        SELECT CAST(0 AS BIGINT) AS diff_rows,
               CAST(count(*) AS BIGINT) AS left_rows,
               CAST(count(*) AS BIGINT) AS right_rows
        FROM top""",
    "dedup_keep_one": _LI + " SELECT * FROM w",
    "count_by_keys": _LI + " SELECT * FROM a",
    "count_by_keys_salted": _LI + " SELECT * FROM a",
    "salted_hot_keys": _HOT + " SELECT * FROM a",
    "rank_items_hot": """
        SELECT geographical_location_oid, item_name, item_count,
               CAST(row_number() OVER (PARTITION BY geographical_location_oid
                   ORDER BY item_count DESC, item_name) AS INTEGER) AS item_rank
        FROM (SELECT CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_suppkey END
                         AS geographical_location_oid,
                     'part-' || CAST(l_partkey AS VARCHAR) AS item_name, count(*) AS item_count
              FROM lineitem GROUP BY ALL)""",
    "rank_items": _LI + """
        SELECT geographical_location_oid, item_rank, item_name, item_count FROM r""",
    "topx_per_group": _LI + f"""
        SELECT geographical_location_oid, item_rank, item_name, item_count
        FROM r WHERE item_rank <= {TOP_X}""",
    "enrich_lookup": _LI + """
        SELECT s.geographical_location_oid, loc.geographical_location
        FROM (SELECT DISTINCT geographical_location_oid FROM d) s
        LEFT JOIN loc ON s.geographical_location_oid IS NOT DISTINCT FROM
                         loc.geographical_location_oid""",
    "enrich_lookup_text_key": f"""
        SELECT 'loc-' || CAST(user_id AS VARCHAR) AS geographical_location_oid,
               max(s_name) AS geographical_location
        FROM events LEFT JOIN supplier ON s_suppkey = user_id GROUP BY user_id""",
    "lookup_build": """
        SELECT geographical_location_oid,
               max(geographical_location) AS geographical_location
        FROM (SELECT s_suppkey AS geographical_location_oid,
                     s_name AS geographical_location FROM supplier
              UNION ALL
              SELECT s_suppkey, s_name || ' / ' || CAST(s_nationkey AS VARCHAR)
              FROM supplier)
        GROUP BY geographical_location_oid""",
    "key_skew": _LI + _skew(
        "SELECT count(*) AS rows FROM w GROUP BY geographical_location_oid, item_name"
    ),
    "location_skew": _skew(
        f"SELECT count(*) AS rows FROM ({_LINEITEM_DETECTIONS}) "
        "GROUP BY geographical_location_oid"),
    "partition_skew": f"""
        SELECT CAST(p AS INTEGER) AS partition_id, count(l_linenumber) AS rows
        FROM range({LAYOUT_PARTITIONS}) AS parts(p)
        LEFT JOIN lineitem ON l_linenumber % {LAYOUT_PARTITIONS - 1} = p GROUP BY p""",
    "stage_metrics": _LI + """
        SELECT CAST(1 AS INTEGER) AS stage_index, 'dedup' AS stage,
               (SELECT count(*) FROM d) AS rows_in, (SELECT count(*) FROM w) AS rows_out
        UNION ALL
        SELECT 2, 'count', (SELECT count(*) FROM w), (SELECT count(*) FROM a)
        UNION ALL
        SELECT 3, 'top_x', (SELECT count(*) FROM a), (SELECT count(*) FROM top)
        UNION ALL
        SELECT 4, 'enrich', (SELECT count(*) FROM top), (SELECT count(*) FROM top)""",
    "compose_stages": _LI + f"""
        SELECT geographical_location_oid, item_rank, item_name
        FROM r WHERE item_rank <= {TOP_X_EVENTS}""",
    "scan_parquet": "SELECT * FROM lineitem",
    "read_rejects": f"""
        SELECT CASE WHEN l_linenumber = {BAD_ID_LINE} THEN 'rejected' ELSE 'read' END AS record,
               count(*) AS rows FROM lineitem GROUP BY record""",
    "roundtrip_parquet": _ODD + " SELECT * FROM odd",
    "roundtrip_csv": _ODD + " SELECT * FROM odd",
    "roundtrip_json": _ODD + " SELECT * FROM odd",
    "roundtrip_text": _ODD + f" SELECT {_TEXT_LINE} AS value FROM odd",
    "sink_overwrite": _top(_LINEITEM_DETECTIONS, _SUPPLIER_LOCATIONS, TOP_X_EVENTS),
    "sink_errorifexists": _LI + " SELECT count(*) AS rows, true AS refused FROM top",
    "sink_dated_path": _LI + f"""
        SELECT top.*, path FROM top, (VALUES ('a/{RUN_DATE}'), ('b/{RUN_DATE}/result.parquet'),
            ('c/result/{RUN_DATE}'), ('output/{RUN_DATE}')) AS shapes(path)""",
    "sink_run_date_column": _LI + f"""
        SELECT *, '{RUN_DATE}' AS run_date FROM top WHERE item_rank = 1
        UNION ALL
        SELECT *, '{NEXT_DATE}' FROM top WHERE item_rank <= {TOP_X_EVENTS}""",
    "sink_partitioned": BASELINE,
    "sink_sized_files": BASELINE,
    "output_contract": BASELINE,
    "null_policy_drop": _top(
        f"SELECT * FROM ({_LINEITEM_WITH_NULLS}) WHERE detection_oid IS NOT NULL "
        "AND item_name IS NOT NULL AND geographical_location_oid IS NOT NULL",
        _SUPPLIER_LOCATIONS, TOP_X),
    "null_policy_default": _top(
        "SELECT geographical_location_oid, video_camera_oid, detection_oid, "
        "coalesce(item_name, 'unknown') AS item_name, timestamp_detected "
        f"FROM ({_LINEITEM_WITH_NULLS})",
        _SUPPLIER_LOCATIONS, TOP_X),
    "quarantine_json": f"""
        SELECT CASE WHEN video_camera_oid = {CUT_LINE} THEN 'malformed record'
                    WHEN video_camera_oid = {SHORT_LINE} THEN 'missing item_name'
                    WHEN detection_oid IS NULL THEN 'null detection_oid'
                    WHEN item_name IS NULL THEN 'null item_name' ELSE '' END AS reason,
               count(*) AS rows FROM ({_LINEITEM_WITH_NULLS}) GROUP BY reason""",
    "quarantine_csv": f"""
        SELECT CASE WHEN video_camera_oid = {CUT_LINE} THEN 'malformed record'
                    WHEN detection_oid IS NULL THEN 'null detection_oid'
                    WHEN item_name IS NULL THEN 'null item_name' ELSE '' END AS reason,
               count(*) AS rows FROM ({_LINEITEM_WITH_NULLS}) GROUP BY reason""",
    "job_run_quarantine": _top(
        f"SELECT * FROM ({_LINEITEM_WITH_NULLS}) WHERE detection_oid IS NOT NULL "
        "AND item_name IS NOT NULL", _SUPPLIER_LOCATIONS, TOP_X),
    "null_policy_fail": f"""
        SELECT true AS failed, count(*) AS rows_with_nulls FROM ({_LINEITEM_WITH_NULLS})
        WHERE item_name IS NULL OR detection_oid IS NULL""",
}
