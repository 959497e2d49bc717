"""Counting per composite key: plain, salted, and salted for hot keys alone."""
from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rankwise.functions.columns import salt_bucket
from rankwise.operators.skew import HotKeys

_SALT = "__salt"
_PARTIAL = "__partial"


def count_by(df: DataFrame, keys: Sequence[str],
             name: str = "item_count") -> DataFrame:
    """Rows per distinct ``keys`` tuple as ``name`` (BIGINT).

    Partial + final hash aggregate: each map task ships one row per key it
    saw, so even a key holding a third of all rows costs the reducer only
    one row per map task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_salted(df: DataFrame, keys: Sequence[str], salts: int,
                    salt_from: Sequence[str] | None = None,
                    name: str = "item_count") -> DataFrame:
    """Same result as ``count_by``, computed in two phases.

    Phase 1 counts per (keys, salt) where the salt is a hash bucket of
    ``salt_from`` (default: every column), spreading one hot key over
    ``salts`` reducers; phase 2 sums the partial counts per key. The salt
    is derived from the row, not drawn at random, so task retries are safe.
    """
    if salts < 1:
        raise ValueError(f"salts must be >= 1, got {salts}")
    source = list(salt_from) if salt_from else list(df.columns)
    partial = (df.groupBy(*keys, salt_bucket(source, salts).alias(_SALT))
               .agg(F.count(F.lit(1)).alias(_PARTIAL)))
    return (partial.groupBy(*keys)
            .agg(F.sum(_PARTIAL).cast("bigint").alias(name)))


def count_by_hot_salted(df: DataFrame, keys: Sequence[str], hot: HotKeys,
                        salt_from: Sequence[str] | None = None,
                        name: str = "item_count") -> DataFrame:
    """Same result as ``count_by``; only the measured hot keys are salted.

    A hot key's rows spread over its own number of buckets, every other key has
    the one bucket 0, so phase 1 has fewer than ``2 * reducers`` groups more than
    there are keys and its map-side combine stays as good as the plain one's.
    The list of hot keys is broadcast: its length is below ``reducers``.
    """
    if not hot.skewed:
        return count_by(df, keys, name)
    spark, source = df.sparkSession, list(salt_from) if salt_from else list(df.columns)
    listed = [StructField(f"__hot_{k}", df.schema[k].dataType) for k in keys]
    rows = [(*key, salts) for key, salts in zip(hot.keys, hot.salts)]
    table = F.broadcast(spark.createDataFrame(
        rows, StructType([*listed, StructField("__salts", LongType())])))
    same = functools.reduce(operator.and_, [df[k].eqNullSafe(table[f"__hot_{k}"]) for k in keys])
    salted = df.join(table, same, "left").withColumn(
        _SALT, F.when(F.col("__salts").isNotNull(),
                      F.pmod(F.xxhash64(*[df[c] for c in source]), F.col("__salts")))
        .otherwise(F.lit(0)))
    partial = (salted.groupBy(*[df[k] for k in keys], _SALT)
               .agg(F.count(F.lit(1)).alias(_PARTIAL)))
    return (partial.groupBy(*keys)
            .agg(F.sum(_PARTIAL).cast("bigint").alias(name)))
