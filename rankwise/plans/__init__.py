"""Composed plans: the top-X jobs and stage composition with metrics."""
from rankwise.plans.jobs import (JobRun, PrepartitionReport, SkewDecision,
                                 decide_salting,
                                 multiset_difference, prepartition_report,
                                 run_top_items_job,
                                 top_items, top_items_stages,
                                 top_items_prepartitioned, top_items_skew_aware)
from rankwise.plans.stages import StageChain, StageMetrics

__all__ = ["JobRun", "PrepartitionReport", "StageChain", "SkewDecision", "StageMetrics",
           "decide_salting", "multiset_difference", "prepartition_report", "run_top_items_job",
           "top_items", "top_items_stages", "top_items_prepartitioned",
           "top_items_skew_aware"]
