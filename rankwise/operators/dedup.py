"""Keep one row per key (detection id)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PACKED = "__kept_row"


def dedup_keep_one(df: DataFrame, key: str,
                   order_by: Sequence[str] = (), *,
                   assume_identical: bool = False) -> DataFrame:
    """One row per distinct ``key`` value; a null key is one ordinary key.

    The surviving row is the smallest by ``order_by`` and then by the
    remaining columns, so conflicting duplicates resolve the same way on
    every run and every layout. It is a plain aggregate: Spark combines
    map-side, so a key repeated a billion times reaches the final reducer
    as at most one row per map task (hot ids never pile up in one task).

    ``assume_identical=True`` is the fast path for inputs whose duplicates
    are full copies: a ``distinct`` over all columns (hash aggregate, no buffer).
    It keeps several rows per key if copies disagree, so it is opt-in.
    """
    if key not in df.columns:
        raise ValueError(f"unknown key column: {key}")
    if assume_identical:
        return df.distinct()
    order = [c for c in order_by if c != key]
    rest = [c for c in df.columns if c != key and c not in order]
    payload = order + rest
    if not payload:
        return df.select(key).distinct()
    kept = (df.groupBy(key)
            .agg(F.min(F.struct(*payload)).alias(_PACKED)))
    return kept.select(*[F.col(key) if c == key else F.col(f"{_PACKED}.{c}").alias(c)
                         for c in df.columns])
