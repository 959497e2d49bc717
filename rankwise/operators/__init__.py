"""Relational operators of the top-X job, each ``f(df, ...) -> DataFrame``."""
from rankwise.operators.counting import count_by, count_by_hot_salted, count_by_salted
from rankwise.operators.dedup import dedup_keep_one
from rankwise.operators.lookup import build_lookup, enrich, lookup_size
from rankwise.operators.nulls import apply_null_policy
from rankwise.operators.ranking import popularity_order, rank_all, rank_within, top_per_group
from rankwise.operators.skew import (HotKeys, SkewReport, choose_salts, hot_keys,
                                     key_sizes, key_skew, key_skew_frame, partition_sizes,
                                     partition_skew)

__all__ = [
    "HotKeys", "SkewReport", "apply_null_policy", "build_lookup", "choose_salts",
    "count_by", "count_by_hot_salted", "count_by_salted", "dedup_keep_one", "enrich",
    "hot_keys", "key_sizes",
    "key_skew", "key_skew_frame", "lookup_size", "partition_sizes",
    "partition_skew", "popularity_order", "rank_all", "rank_within", "top_per_group",
]
