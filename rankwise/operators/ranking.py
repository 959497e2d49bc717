"""Ranking within groups and top-X per group."""
from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwise.session import scratch_path

_RANGE, _OTHER, _BEFORE = "__range", "__other_range", "__before"


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                rank_col: str = "item_rank") -> DataFrame:
    """Add ``rank_col`` = 1, 2, 3... per group in ``order`` (ties split)."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(window))


def rank_all(df: DataFrame, group: Sequence[str], order: Sequence[Column],
             rank_col: str = "item_rank") -> DataFrame:
    """``rank_within`` for every row, without one task per group.

    Two levels: rows are dealt to ranges of (group, order), so a large group spans
    many ranges; a row's rank is its place inside its range plus the rows that its
    group has in earlier ranges. ``df`` itself runs once: its rows are written to the
    shared folder, and the bounds of the ranges come from a sample of those files.
    The dealt rows are written too, as both levels must see the same ranges; the
    number of rows per range and group is small and joined back. The last column
    breaks no ties by itself: equal rows get their ranks in any order.
    """
    rows = _written(df, "ranked")
    dealt = _written(rows.repartitionByRange(*[F.col(c) for c in group], *order)
                     .withColumn(_RANGE, F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*group, _RANGE).agg(F.count(F.lit(1)).alias(_BEFORE)) \
        .withColumn(_BEFORE, F.coalesce(F.sum(_BEFORE).over(earlier), F.lit(0)))
    sizes = sizes.select(F.col(_RANGE).alias(_OTHER), F.col(_BEFORE),
                         *[F.col(c).alias(f"__of_{c}") for c in group])
    inside = Window.partitionBy(_RANGE, *group).orderBy(*order)
    placed = dealt.withColumn(rank_col, F.row_number().over(inside))
    same = [placed[_RANGE] == sizes[_OTHER]]
    same += [placed[c].eqNullSafe(sizes[f"__of_{c}"]) for c in group]
    out = placed.join(sizes, functools.reduce(operator.and_, same))
    return out.select(*df.columns,
                      (F.col(rank_col) + F.col(_BEFORE)).cast("int").alias(rank_col))


def popularity_order(count_col: str, item_col: str) -> list[Column]:
    """Most frequent first; equal counts by item name (binary order)."""
    return [F.col(count_col).desc(), F.col(item_col).asc()]


def top_per_group(df: DataFrame, group: Sequence[str], count_col: str,
                  item_col: str, top_x: int | None, *,
                  rank_col: str = "item_rank",
                  keep_count: bool = False) -> DataFrame:
    """The ``top_x`` most frequent items of each group, ranked from 1.

    ``top_x=None`` ranks everything (see ``rank_all``). The rank filter sits directly on the
    window so Catalyst plans a partial ``WindowGroupLimit`` before the
    shuffle: each map task forwards at most ``top_x`` rows per group, and a
    group with millions of items is never shipped or sorted whole.
    """
    if top_x is not None and top_x < 0:
        raise ValueError(f"top_x must be >= 0, got {top_x}")
    order = popularity_order(count_col, item_col)
    if top_x is None:
        ranked = rank_all(df, group, order, rank_col)
    else:
        ranked = rank_within(df, group, order, rank_col) \
            .filter(F.col(rank_col) <= F.lit(top_x))
    columns = [*group, rank_col, item_col] + ([count_col] if keep_count else [])
    return ranked.select(*columns)
