"""Measured sizes, so that a side is broadcast only when it is known to be small."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
# A hashed row costs its values, their slots and the entries that find it.
ROW_BYTES = 160


def measured_bytes(df: DataFrame, *extra: Column) -> int:
    """Bytes that ``df`` takes in a hash relation: one row is the answer."""
    wide = [F.octet_length(F.col(c)) if t == "string"
            else F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
            for c, t in df.dtypes if t == "string" or t.startswith(("array", "struct", "map"))]
    per_row = F.lit(ROW_BYTES + 8 * len(df.columns)).cast("long")
    for c in (*wide, *extra):
        per_row = per_row + F.coalesce(c, F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]


def hinted(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if its measured size allows it, and whether; else
    with a hint to merge, so that no estimate from file sizes broadcasts it."""
    small = measured_bytes(df) <= limit
    return (F.broadcast(df) if small else df.hint("merge")), small
