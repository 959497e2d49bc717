"""Data contracts: the detections, locations and output schemas.

Columns are always resolved by name. ``conform`` applies a contract to a
DataFrame: it selects the contract columns in contract order, casts them,
and turns a null in a non-nullable column into a task failure. Nullability
flags alone are not trusted (parquet reads come back all-nullable), so the
check is done on values, inside the same projection that feeds the sink.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)

from rankwise.functions.columns import not_null

# Names, types and nullability of the data contracts.
DETECTIONS = StructType([
    StructField("geographical_location_oid", LongType(), False),
    StructField("video_camera_oid", LongType(), False),
    StructField("detection_oid", LongType(), False),
    StructField("item_name", StringType(), False),
    StructField("timestamp_detected", LongType(), False),
])

LOCATIONS = StructType([
    StructField("geographical_location_oid", LongType(), False),
    StructField("geographical_location", StringType(), False),
])

OUTPUT = StructType([
    StructField("geographical_location_oid", LongType(), False),
    StructField("geographical_location", StringType(), True),
    StructField("item_rank", IntegerType(), False),
    StructField("item_name", StringType(), False),
])


@dataclass(frozen=True)
class Columns:
    """Column names the jobs work on; defaults follow the contracts above.

    Every operator takes names, so the jobs run unchanged on other table
    layouts by passing a different ``Columns``.
    """
    location: str = "geographical_location_oid"
    camera: str = "video_camera_oid"
    detection: str = "detection_oid"
    item: str = "item_name"
    timestamp: str = "timestamp_detected"
    location_name: str = "geographical_location"
    rank: str = "item_rank"
    count: str = "item_count"

    @property
    def dedup_order(self) -> list[str]:
        """Tie-break among rows sharing a detection id: earliest first."""
        return [self.timestamp, self.location, self.camera, self.item]


DEFAULT_COLUMNS = Columns()


def conform(df: DataFrame, schema: StructType, *,
            check_nulls: bool = True) -> DataFrame:
    """Select ``schema``'s columns in order, cast, and enforce non-nulls."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for contract: {missing}")
    projected = []
    for field in schema.fields:
        column = F.col(field.name).cast(field.dataType)
        if check_nulls and not field.nullable:
            column = not_null(column, f"null value in non-nullable column "
                                      f"'{field.name}'")
        projected.append(column.alias(field.name))
    return df.select(*projected)
