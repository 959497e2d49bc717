"""A training-data pipeline over ``documents``: five stages, in order.

Each stage is one operator on all that the stage before it kept. The first four
return the columns of ``documents``; the last adds each document's place in the
mixture. ``run`` writes every result to the shared folder and reads it again, so
a lost executor costs at most its part of one stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankwise.llm import decontaminate, line_templates, mixing, ngram_join, quality_rules
from rankwise.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, and documents that they were all of."""
    return line_templates.clean(docs, n_chars="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that of the least id."""
    return ngram_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the mixture of sources."""
    return mixing.mix(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup),
          ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture)]

# The outlier estimates and the forest are not plain SQL: tests/llm compares the
# pipeline with its brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
