"""rankwise: ranked per-group popularity ("top X items per location") on Spark.

Everything is DataFrame code: Catalyst plans the whole job from the parquet
scan to the sink; there is no row-level Python on any data path.
"""
from rankwise.contracts import DETECTIONS, LOCATIONS, OUTPUT, Columns, conform
from rankwise.plans import (StageChain, run_top_items_job, top_items,
                            top_items_prepartitioned, top_items_skew_aware)
from rankwise.sources import read, write

__all__ = ["Columns", "DETECTIONS", "LOCATIONS", "OUTPUT", "StageChain", "conform",
           "read", "run_top_items_job", "top_items", "top_items_prepartitioned",
           "top_items_skew_aware", "write"]
