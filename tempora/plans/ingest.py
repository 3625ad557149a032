"""All sources in their order, each under the run log; those that may fail don't stop the others."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tempora.clock import Clock
from tempora.plans.runs import Run


class SourceError(RuntimeError):
    """A source that can't be read as it should be."""


@dataclass(frozen=True)
class Step:
    """read(run) lands a source, counts with run.add and says in a few words what it did."""

    name: str
    pipeline: str
    read: Callable[[Run], str]
    best_effort: bool = False


@dataclass(frozen=True)
class Result:
    name: str
    summary: str
    failed: bool = False


def ingest(spark: SparkSession, log: str, clock: Clock, steps: Sequence[Step], only: str | None = None) -> list[Result]:
    """What each step did, in order. A SourceError is logged as FAILED; it goes on unless the step is best effort."""
    if only is not None and only not in [s.name for s in steps]:
        raise ValueError(f"no source {only}")
    out = []
    for step in steps:
        if only not in (None, step.name):
            continue
        try:
            with Run(spark, log, step.pipeline, clock) as run:
                out.append(Result(step.name, step.read(run)))
        except SourceError as e:
            if not step.best_effort:
                raise
            out.append(Result(step.name, f"failed: {e}", True))
    return out
