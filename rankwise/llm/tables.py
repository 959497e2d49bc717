"""Intermediate tables in the folder that all executors share."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankwise.session import scratch_path


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read again: its lineage ends at files that survive the
    executors that wrote them, and it is computed once however often it is used."""
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
