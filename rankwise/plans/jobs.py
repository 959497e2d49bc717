"""The top-X job: dedup -> count -> rank/top-X -> name lookup -> sink.

Three plan shapes give the same answer; the caller picks one:

* ``top_items``: dedup (exchange on id), count (exchange on location+item,
  map-side combined), rank (exchange on location, after a partial
  ``WindowGroupLimit`` so only top-X candidates move).
* ``top_items_skew_aware``: the count spreads measured hot keys over salts.
* ``top_items_prepartitioned``: one hash partitioning on location serves both
  count and rank: one exchange fewer, which carries every deduplicated row and
  puts a location whole into one task. ``prepartition_report`` measures whether
  that suits the data.

Plans are built from measurements: the bytes of the lookup (one aggregate; pass
``lookup_bytes`` to reuse one) and, for the skew-aware shape, the hot keys (one
job; pass ``decision``). Everything else is lazy.
"""
from __future__ import annotations

import datetime as _dt
import functools
import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.contracts import (DEFAULT_COLUMNS, DETECTIONS, LOCATIONS, OUTPUT,
                                Columns, conform)
from rankwise.operators.counting import (count_by, count_by_hot_salted,
                                         count_by_salted)
from rankwise.operators.dedup import dedup_keep_one
from rankwise.operators.lookup import (DEFAULT_BROADCAST_LIMIT, build_lookup,
                                      enrich, lookup_size)
from rankwise.operators.nulls import apply_null_policy
from rankwise.operators.ranking import top_per_group
from rankwise.operators.skew import HotKeys, hot_keys
from rankwise.plans.stages import StageChain, StageMetrics
from rankwise.sources.formats import read, resolve_format, split_rejects, write
from rankwise.sources.quarantine import Split, read_checked, write_split

_log = logging.getLogger(__name__)


def detection_columns(cols: Columns, assume_identical: bool) -> list[str]:
    """Columns the job reads; the fast path needs only id, location, item."""
    if assume_identical:
        return [cols.detection, cols.location, cols.item]
    return [cols.location, cols.camera, cols.detection, cols.item, cols.timestamp]


def dedup_stage(cols: Columns = DEFAULT_COLUMNS, *,
                assume_identical: bool = False):
    def dedup(df: DataFrame) -> DataFrame:
        return dedup_keep_one(df.select(*detection_columns(cols, assume_identical)),
                              cols.detection, cols.dedup_order,
                              assume_identical=assume_identical)
    return dedup


def count_stage(cols: Columns = DEFAULT_COLUMNS, salts: int | None = None,
                hot: HotKeys | None = None):
    """Rows per (location, item): plain, with ``salts`` for all keys, or ``hot``."""
    keys = [cols.location, cols.item]

    def count(df: DataFrame) -> DataFrame:
        if hot is not None:
            return count_by_hot_salted(df, keys, hot, salt_from=[cols.detection],
                                       name=cols.count)
        if salts:
            return count_by_salted(df, keys, salts, salt_from=[cols.detection],
                                   name=cols.count)
        return count_by(df, keys, name=cols.count)
    return count


def top_stage(top_x: int, cols: Columns = DEFAULT_COLUMNS):
    if top_x < 0:
        raise ValueError(f"top_x must be >= 0, got {top_x}")

    def top_x_per_location(df: DataFrame) -> DataFrame:
        return top_per_group(df, [cols.location], cols.count, cols.item, top_x,
                             rank_col=cols.rank)
    return top_x_per_location


def enrich_stage(locations: DataFrame, cols: Columns = DEFAULT_COLUMNS,
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 lookup_bytes: int | None = None):
    lookup = build_lookup(locations, cols.location, cols.location_name)
    if lookup_bytes is None:
        # Measured on the raw lookup (a scan and a global aggregate, no shuffle):
        # de-duplication only removes rows, so this bounds the built lookup.
        _, lookup_bytes = lookup_size(locations, cols.location, cols.location_name)

    def enrich_names(df: DataFrame) -> DataFrame:
        return enrich(df, lookup, cols.location, cols.location_name,
                      position=1, broadcast_limit=broadcast_limit,
                      size_bound=lookup_bytes)
    return enrich_names


def _null_stage(cols: Columns, null_policy: str):
    return functools.partial(apply_null_policy, policy=null_policy, id_col=cols.detection,
                             item_col=cols.item, checked=[cols.location])


def top_items_stages(locations: DataFrame, top_x: int, *,
                     cols: Columns = DEFAULT_COLUMNS, salts: int | None = None,
                     hot: HotKeys | None = None, prepartition: bool = False,
                     assume_identical: bool = False, null_policy: str = "keep",
                     broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                     lookup_bytes: int | None = None) -> StageChain:
    """The job as composable stages (used directly or with metrics)."""
    stages = {}
    if null_policy != "keep":
        stages["null_policy"] = _null_stage(cols, null_policy)
    stages["dedup"] = dedup_stage(cols, assume_identical=assume_identical)
    if prepartition:
        stages["by_location"] = lambda df: df.repartition(cols.location)
    stages["count"] = count_stage(cols, salts, hot)
    stages["top_x"] = top_stage(top_x, cols)
    stages["enrich"] = enrich_stage(locations, cols, broadcast_limit, lookup_bytes)
    return StageChain(stages.values(), stages)


def top_items(detections: DataFrame, locations: DataFrame, top_x: int, **options) -> DataFrame:
    """Top ``top_x`` items per location with the location name.

    Output columns: location, location name, rank, item. Options are those of
    ``top_items_stages``.
    """
    return top_items_stages(locations, top_x, **options)(detections)


@dataclass(frozen=True)
class SkewDecision:
    """What the skew-aware shape does: the hot keys it salts, if any."""
    hot: HotKeys

    @property
    def salted(self) -> bool:
        return self.hot.skewed


def decide_salting(detections: DataFrame, cols: Columns = DEFAULT_COLUMNS, *,
                   reducers: int | None = None) -> SkewDecision:
    """Measure the hot (location, item) keys of the raw input.

    It reads two columns and ships a sketch of bounded size per map task; only if it
    names a key, a second pass counts the rows of those named (see ``hot_keys``).
    Copies that dedup will remove are counted: they can make a key hot that is not,
    which costs it a few buckets and changes no result. A plain count combines
    map-side too, so salting pays where the partial counts of one key, one per map
    task, are themselves too many for one reducer, or where ``count`` is preceded by
    no combine; ``decision.hot`` tells what was found.
    """
    return SkewDecision(hot_keys(detections, [cols.location, cols.item], reducers))


def top_items_skew_aware(detections: DataFrame, locations: DataFrame, top_x: int, *,
                         cols: Columns = DEFAULT_COLUMNS, decision: SkewDecision | None = None,
                         reducers: int | None = None, **options) -> tuple[DataFrame, SkewDecision]:
    """``top_items`` whose count salts the hot keys, and what was decided."""
    decision = decision or decide_salting(detections, cols, reducers=reducers)
    return top_items(detections, locations, top_x, cols=cols, hot=decision.hot,
                     **options), decision


def top_items_prepartitioned(detections: DataFrame, locations: DataFrame, top_x: int,
                             **options) -> DataFrame:
    """``top_items`` with count and rank sharing one location partitioning."""
    return top_items(detections, locations, top_x, prepartition=True, **options)


@dataclass(frozen=True)
class PrepartitionReport:
    """Whether one partitioning by location suits the data."""
    locations: int
    rows: int              # of the raw input
    pairs: int             # distinct (location, item)
    largest: int           # rows of the largest location
    reducers: int

    @property
    def largest_share(self) -> float:
        """Rows of the largest location over an even share of a reducer."""
        return self.largest * self.reducers / self.rows if self.rows else 0.0

    @property
    def rows_per_pair(self) -> float:
        """What the plain shape's map-side combine saves on the exchange kept here."""
        return self.rows / self.pairs if self.pairs else 0.0

    @property
    def suits(self) -> bool:
        return self.locations >= self.reducers and self.largest_share <= 1.5 \
            and self.rows_per_pair <= 1.5


def prepartition_report(detections: DataFrame, cols: Columns = DEFAULT_COLUMNS, *,
                        reducers: int | None = None) -> PrepartitionReport:
    """One row of measurements, for the caller to choose a shape by."""
    if reducers is None:
        reducers = int(detections.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_pair = count_by(detections, [cols.location, cols.item], "n")
    per_location = per_pair.groupBy(cols.location).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("pairs"))
    row = per_location.agg(F.count(F.lit(1)), F.sum("n"), F.sum("pairs"), F.max("n")).first()
    return PrepartitionReport(*[int(v or 0) for v in row], reducers)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows not matched across the two inputs, and both sizes.

    ``diff_rows = 0`` means equal as multisets (``exceptAll`` both ways),
    computed with a single aggregate over the union; nulls compare equal.
    """
    columns = left.columns
    tagged = (left.select(*columns, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
              .unionByName(right.select(*columns, F.lit(0).alias("__l"),
                                        F.lit(1).alias("__r"))))
    per_row = tagged.groupBy(*columns).agg(F.sum("__l").alias("l"),
                                           F.sum("__r").alias("r"))
    return per_row.agg(
        F.coalesce(F.sum(F.abs(F.col("l") - F.col("r"))), F.lit(0))
        .cast("bigint").alias("diff_rows"),
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("right_rows"))


JOBS = ("baseline", "skew_aware", "prepartitioned")


@dataclass(frozen=True)
class JobRun:
    output_path: str
    metrics: StageMetrics
    decision: SkewDecision | None
    rejected: dict[str, int]       # records left out, by input
    splits: dict[str, Split] = field(default_factory=dict)     # of a job with a quarantine


def run_top_items_job(spark: SparkSession, detections_path: str,
                      locations_path: str, output_path: str, top_x: int, *,
                      job: str = "baseline", input_format: str = "parquet",
                      output_format: str = "parquet",
                      run_date: str | _dt.date | None = None,
                      mode: str = "overwrite", null_policy: str = "fail",
                      assume_identical: bool = False, malformed: str = "fail",
                      multiline: bool = False, quarantine_path: str | None = None,
                      date_column: str | None = None) -> JobRun:
    """The whole job: read, compute, write dated output.

    Inputs are read under the detections / locations contracts (see ``read``): by
    name, and a missing column or a value that does not parse fails the job. With
    ``malformed="reject"`` such records are left out, counted and logged. Nulls
    that stand in the input fail it too unless ``null_policy`` says otherwise.

    With ``quarantine_path`` neither stops the job: each input is written there in
    one pass, split into rows that keep the contract, which the job goes on with, and
    rows that break it, each with its reason (see ``write_split``). ``date_column``
    writes the run date as a partition column in place of a path element.

    One action computes and writes; stage row counts are observed in it. Before it
    run the measurements the plan needs: the lookup's bytes, hot keys for the
    ``skew_aware`` job, rejected records, names of JSON inputs. All of them are
    in ``metrics.seconds``.
    """
    if resolve_format(input_format) == "text":
        raise ValueError("text input has no columns; use parquet, csv or json")
    if job not in JOBS:
        raise ValueError(f"unknown job {job!r}; use one of {JOBS}")
    start = time.perf_counter()
    inputs, rejected, splits = [], {}, {}
    for name, path, schema in (("detections", detections_path, DETECTIONS),
                               ("locations", locations_path, LOCATIONS)):
        if quarantine_path is not None:
            split = write_split(read_checked(spark, input_format, path, schema, multiline=multiline),
                                f"{quarantine_path.rstrip('/')}/{name}", schema)
            rejected[name] = sum(split.reasons.values())
            _log.info("%s: %d rows kept, quarantined %s", name, split.kept_rows, split.reasons)
            splits[name] = split
            inputs.append(split.kept(spark))
            continue
        df = read(spark, input_format, path, schema=schema, malformed=malformed,
                  multiline=multiline)
        if malformed == "reject" and resolve_format(input_format) != "parquet":
            df, bad = split_rejects(df)
            rejected[name] = bad.count()
            _log.info("%s: %d malformed records left out", name, rejected[name])
        inputs.append(conform(df, schema, check_nulls=False))
    detections, locations = inputs
    decision = decide_salting(detections) if job == "skew_aware" else None
    chain = top_items_stages(
        locations, top_x, hot=decision.hot if decision else None,
        prepartition=job == "prepartitioned",
        null_policy=null_policy, assume_identical=assume_identical)
    path, metrics = chain.run(
        detections,
        lambda df: write(df, output_format, output_path, mode=mode,
                         run_date=run_date, schema=OUTPUT, date_column=date_column))
    metrics.seconds = time.perf_counter() - start
    return JobRun(path, metrics, decision, rejected, splits)
