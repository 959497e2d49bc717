"""Map the shared test tables onto the detections / locations contracts.

``lineitem`` becomes detections: ``(l_orderkey, l_linenumber)`` repeats in
the data, often with different payloads, so deduplication changes the
answer. ``events`` becomes detections delivered twice (at-least-once
delivery): exact copies, five item values, many count ties. The lookup is
``supplier``, whole; users run past its keys at every scale factor, so some
locations of ``events`` have no name.

Only the columns a contract needs are selected, so the parquet scan reads
just those.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.contracts import DEFAULT_COLUMNS as C

# Fixed value: items are the part key modulo this many categories.
ITEM_CATEGORIES = 40

# The columns each adapter reads, with their types.
# Giving the schema skips footer-based inference when the plan is built.
# The timestamps are stored without time zone; reading them as TIMESTAMP
# takes the stored microseconds as UTC instants, independent of the
# session time zone, with no per-row conversion.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, "
                "l_linenumber INT, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micros(ts: str) -> Column:
    """Microseconds since the epoch (the stored value; see SCHEMAS)."""
    return F.unix_micros(F.col(ts))


def detections_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias(C.location),
        F.col("l_linenumber").cast("bigint").alias(C.camera),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(C.detection),
        F.concat(F.lit("item-"),
                 (F.col("l_partkey") % ITEM_CATEGORIES).cast("string"))
        .alias(C.item),
        _micros("l_shipdate").alias(C.timestamp),
    )


def detections_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both deliveries come from one scan of the table.
    twice = table(spark, sf_dir, "events").select(
        "*", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    return twice.select(
        F.col("user_id").alias(C.location),
        (F.col("event_id") % 16).alias(C.camera),
        F.col("event_id").alias(C.detection),
        F.col("event_type").alias(C.item),
        _micros("ts").alias(C.timestamp),
    )


def locations_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "supplier")
            .select(F.col("s_suppkey").alias(C.location),
                    F.col("s_name").alias(C.location_name)))

