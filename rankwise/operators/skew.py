"""Skew measurement: rows per partition and rows per key.

Both reduce to ``max / avg`` of a size distribution. They are computed with
aggregates whose output is one row, so nothing but that row reaches the
driver.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Skew is a max/avg size ratio strictly above 1.5; a salted key
# gets two buckets at least.
SKEW_THRESHOLD = 1.5
MIN_SALTS = 2


@dataclass(frozen=True)
class SkewReport:
    factor: float        # max / avg; 0.0 when there are no rows or units
    skewed: bool         # factor > threshold
    units: int           # partitions or keys measured
    rows: int
    largest: int         # rows in the largest unit


def _report(largest, rows, units, threshold) -> SkewReport:
    largest = int(largest or 0)
    rows = int(rows or 0)
    factor = largest * units / rows if units and rows else 0.0
    return SkewReport(factor, factor > threshold, units, rows, largest)


def partition_sizes(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """(partition_id, rows) of the layout that ``df`` runs with.

    ``partitions`` is the number of partitions that ``df`` was dealt to, so that
    empty ones are listed too; without it only those that hold rows are. Nothing
    runs while the plan is built.
    """
    counted = (df.groupBy(F.spark_partition_id().alias("partition_id"))
               .agg(F.count(F.lit(1)).alias("rows")))
    if partitions is None:
        return counted
    every = df.sparkSession.range(partitions).select(
        F.col("id").cast("int").alias("partition_id"))
    return (every.join(counted, "partition_id", "left")
            .select("partition_id", F.coalesce("rows", F.lit(0)).alias("rows")))


def partition_skew(df: DataFrame, threshold: float = SKEW_THRESHOLD,
                   partitions: int | None = None) -> SkewReport:
    """Skew of the layout: largest partition over the average one.

    Without ``partitions`` the average is over those up to the last that holds
    rows, which is all that the rows themselves can tell.
    """
    row = (partition_sizes(df)
           .agg(F.max("rows").alias("largest"), F.sum("rows").alias("rows"),
                F.max(F.col("partition_id") + 1).alias("units"))
           .first())
    return _report(row["largest"], row["rows"], partitions or int(row["units"] or 0), threshold)


def key_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key tuple (the distribution salting is meant to flatten)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def key_skew_frame(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys, rows, largest and skew_factor = largest * keys / rows.

    That is max / avg computed as one division of exact integers, so every
    engine returns the same double.
    """
    sizes = key_sizes(df, keys)
    return sizes.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.max("rows"), F.lit(0)).cast("bigint").alias("largest"),
    ).withColumn(
        "skew_factor",
        F.when(F.col("rows") > 0,
               (F.col("largest") * F.col("keys")) / F.col("rows"))
        .otherwise(F.lit(0.0)))


def key_skew(df: DataFrame, keys: Sequence[str],
             threshold: float = SKEW_THRESHOLD) -> SkewReport:
    """Skew of the key distribution: largest key over the average key."""
    row = key_skew_frame(df, keys).first()
    return _report(row["largest"], row["rows"], row["keys"], threshold)


def choose_salts(factor: float) -> int:
    """Salt buckets for a skew factor when all keys are salted alike."""
    return max(MIN_SALTS, math.ceil(factor))


# Fixed values of Spark's frequent-items sketch: a map of m slots tracks 3/4 m keys
# and is off by at most 3.5 / m of all rows; a million keys may be tracked.
MAP_FILL = 0.75
MAP_ERROR = 3.5
MAX_MAP = 1 << 20
# Sketches of map tasks are merged in so many groups, and those in one.
MERGE_GROUPS = 256


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than an even share of one reducer, and their salts."""
    rows: int                        # of all keys
    reducers: int
    keys: list[tuple]                # key values, most rows first
    salts: list[int]                 # buckets of each
    error: float = 0.0               # of the sketch that found them, as a share of the rows
    candidates: int = 0              # keys that the sketch named

    @property
    def skewed(self) -> bool:
        return bool(self.keys)


def sketch_slots(reducers: int) -> int:
    """Slots with which the sketch is off by a quarter of a reducer's share or less."""
    return min(MAX_MAP, max(64, 1 << (math.ceil(4 * MAP_ERROR * reducers) - 1).bit_length()))


def frequent_codes(df: DataFrame, keys: Sequence[str], slots: int) -> tuple[int, dict[int, int]]:
    """Rows of ``df`` and the most frequent hashes of its keys with their estimates.

    Every map task fills one sketch of ``slots`` slots, whatever the number of keys,
    and sketches are all that moves. An estimate is never below the true count and
    above it by at most 3.5 / slots of the rows, and a key with twice that many rows
    is always there.
    """
    tracked = int(MAP_FILL * slots)
    states = df.select(F.xxhash64(*keys).alias("code")) \
        .groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("group")) \
        .agg(F.expr(f"approx_top_k_accumulate(code, {tracked})").alias("state"),
             F.count(F.lit(1)).alias("rows"))
    # Grouped, so that no input gives no row: an empty state cannot be read.
    row = states.groupBy((F.col("rows") < 0).alias("none")).agg(
        F.expr("approx_top_k_combine(state)").alias("state"), F.sum("rows").alias("rows")) \
        .select("rows", F.expr(f"approx_top_k_estimate(state, {tracked})").alias("top")).first()
    if row is None:
        return 0, {}
    return int(row["rows"]), {x["item"]: x["count"] for x in row["top"]}


def hot_keys(df: DataFrame, keys: Sequence[str], reducers: int | None = None) -> HotKeys:
    """Keys that hold more than ``1 / reducers`` of the rows.

    A mergeable sketch names the candidates in one pass that shuffles sketches alone;
    its error is a quarter of a reducer's share (see ``sketch_slots``; more only from
    some 75,000 reducers on), so no hot key is missed. Where there are any, a second
    pass counts the rows of the candidates exactly. Fewer than ``reducers`` keys can
    be hot, which bounds the list that reaches the driver. Each gets a bucket for
    every reducer's share that it fills, so all buckets together are fewer than twice
    the reducers.
    """
    spark = df.sparkSession
    if reducers is None:
        reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = sketch_slots(reducers)
    total, estimates = frequent_codes(df, keys, slots)
    named = [(code,) for code, rows in estimates.items() if rows * reducers > total]
    error = MAP_ERROR / slots
    if reducers <= 1 or not named:
        return HotKeys(total, reducers, [], [], error, len(named))
    codes = F.broadcast(spark.createDataFrame(named, "code long"))
    found = df.select(*keys, F.xxhash64(*keys).alias("__code")).join(
        codes, F.col("__code") == F.col("code"), "left_semi")
    sizes = key_sizes(found, keys).filter(F.col("rows") * reducers > total).collect()
    hot = sorted(sizes, key=lambda r: (-r["rows"], repr(r)))
    return HotKeys(total, reducers, [tuple(r[k] for k in keys) for r in hot],
                   [max(MIN_SALTS, -(-r["rows"] * reducers // total)) for r in hot],
                   error, len(named))
