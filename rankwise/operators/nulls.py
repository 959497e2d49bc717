"""Null handling for the id and item columns of the detections input."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.columns import not_null

POLICIES = ("keep", "drop", "default", "fail")
# Fixed value: item name used for a null item under the "default" policy.
DEFAULT_ITEM = "unknown"


def apply_null_policy(df: DataFrame, policy: str, *, id_col: str,
                      item_col: str, checked: Sequence[str] = (),
                      default_item: str = DEFAULT_ITEM) -> DataFrame:
    """Handle nulls in ``id_col`` / ``item_col`` (and ``checked`` columns).

    * ``keep``: leave them; null ids then collapse into one detection.
    * ``drop``: remove rows with a null id, item or checked column.
    * ``default``: null items become ``default_item``; null ids are kept.
    * ``fail``: a null in any of them fails the job. The guard replaces the
      column itself, so column pruning cannot drop the check.
    """
    policy = policy.lower()
    if policy not in POLICIES:
        raise ValueError(f"unknown null policy {policy!r}; use one of {POLICIES}")
    guarded = [id_col, item_col, *[c for c in checked if c not in (id_col, item_col)]]
    if policy == "keep":
        return df
    if policy == "drop":
        return df.dropna(how="any", subset=guarded)
    if policy == "default":
        return df.withColumn(item_col, F.coalesce(F.col(item_col),
                                                  F.lit(default_item)))
    return df.select(*[not_null(F.col(c), f"null value in column '{c}'").alias(c)
                       if c in guarded else F.col(c) for c in df.columns])
