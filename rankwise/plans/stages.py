"""Ordered composition of DataFrame stages, with single-pass row metrics.

A stage is any ``DataFrame -> DataFrame`` callable. Composition stays one
lazy plan, so Catalyst optimises across stage borders. Metrics attach an
``Observation`` after each stage: the row counts are collected by the one
action that runs the plan -- no persist, no extra count jobs. Stages are
fused into whole-plan tasks, so a time per stage does not exist; only the
total is reported.
Counts travel as accumulators: if a lost executor forces a stage to be
recomputed, its rows may be counted again. Results are not affected.
"""
from __future__ import annotations

import functools
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def stage_name(stage: Stage) -> str:
    inner = stage.func if isinstance(stage, functools.partial) else stage
    return getattr(inner, "__name__", type(inner).__name__)


def _observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    obs = Observation(f"{label}-{uuid.uuid4().hex[:12]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.max(F.spark_partition_id() + 1).alias("partitions")), obs


def _observed_values(obs: Observation) -> tuple[int | None, int | None]:
    """(rows, partitions) observed, or Nones when the stage never ran.

    Partitions are counted up to the last that holds rows, as the stage
    actually ran (after AQE coalescing); rows cannot tell of empty ones
    behind it. A stage never runs
    when the optimizer replaces the plan by an empty relation (e.g. a top-0
    filter); its observation node goes with it.
    """
    try:
        values = obs.get
    except Exception:  # noqa: BLE001 -- pyspark raises a py4j error here
        return None, None
    parts = values.get("partitions")
    return int(values["rows"]), (int(parts) if parts is not None else 0)


@dataclass
class StageMetrics:
    """Row counts per stage, readable after the plan's action has run."""
    names: list[str]
    observations: list[Observation]          # input first, then each stage
    seconds: float | None = None
    _values: list[tuple[int | None, int | None]] | None = field(default=None, repr=False)

    def _observed(self) -> list[tuple[int | None, int | None]]:
        if self._values is None:
            self._values = [_observed_values(o) for o in self.observations]
        return self._values

    def rows(self) -> list[int | None]:
        return [rows for rows, _ in self._observed()]

    def partitions(self) -> list[int | None]:
        return [parts for _, parts in self._observed()]

    def table(self) -> list[tuple[int, str, int | None, int | None]]:
        """``(stage_index, stage, rows_in, rows_out)`` per stage."""
        counts = self.rows()
        return [(i + 1, name, counts[i], counts[i + 1])
                for i, name in enumerate(self.names)]

    def records(self) -> list[dict]:
        """``table`` as dicts, with ``used_partitions`` of each stage's output."""
        used = self.partitions()[1:]
        return [dict(zip(("stage_index", "stage", "rows_in", "rows_out"), row),
                     used_partitions=n) for row, n in zip(self.table(), used)]


class StageChain:
    """Stages applied in order; members are checked when it is built."""

    def __init__(self, stages: Iterable[Stage], names: Iterable[str] | None = None):
        members = list(stages)
        for member in members:
            if not callable(member):
                raise TypeError(
                    f"stage must be callable, got {type(member).__name__}")
        self._stages = members
        self._names = list(names) if names is not None else [
            stage_name(s) for s in members]
        if len(self._names) != len(self._stages):
            raise ValueError("one name per stage is required")

    @property
    def names(self) -> list[str]:
        return list(self._names)

    def before(self, name: str) -> StageChain:
        """The chain of the stages in front of the one called ``name``."""
        end = self._names.index(name)
        return StageChain(self._stages[:end], self._names[:end])

    def __call__(self, df: DataFrame) -> DataFrame:
        return functools.reduce(lambda acc, stage: acc.transform(stage),
                                self._stages, df)

    def with_metrics(self, df: DataFrame) -> tuple[DataFrame, StageMetrics]:
        """The composed plan with a row-count observation after every stage.

        Read ``StageMetrics`` only after an action on the returned frame.
        """
        current, first = _observed(df, "input")
        observations = [first]
        for name, stage in zip(self._names, self._stages):
            current, obs = _observed(current.transform(stage), name)
            observations.append(obs)
        return current, StageMetrics(self._names, observations)

    def run(self, df: DataFrame, sink: Callable[[DataFrame], object]
            ) -> tuple[object, StageMetrics]:
        """Compose, run ``sink`` (the one action) and return its result + metrics."""
        planned, metrics = self.with_metrics(df)
        start = time.perf_counter()
        result = sink(planned)
        metrics.seconds = time.perf_counter() - start
        metrics.rows()
        return result, metrics
