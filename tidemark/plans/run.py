"""What a run writes about itself."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidemark.sources import logs


@dataclass
class RunLog:
    """Rows a run writes about itself, kept until they are appended."""

    table: str
    started: datetime
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    steps: list[tuple] = field(default_factory=list)
    metrics: list[tuple] = field(default_factory=list)
    clock: Callable[[], float] = time.monotonic

    def __post_init__(self):
        self._zero = self.clock()

    def elapsed(self) -> float:
        return self.clock() - self._zero

    def now(self) -> datetime:
        return self.started + timedelta(seconds=self.elapsed())

    def step(self, name: str, status: str, rows=None, error=None, seconds=None) -> None:
        self.steps.append(
            (self.run_id, self.table, name, status, rows, error or None, seconds, self.now())
        )

    def finish(self, status: str, rows=None, error=None) -> float:
        """Log the end of the run; its time less its duration is exactly the start."""
        total = round(self.elapsed(), 6)
        self.step("flow_complete", status, rows, error, total)
        self.steps[-1] = (*self.steps[-1][:-1], self.started + timedelta(seconds=total))
        return total

    def metric(self, name: str, value: float, unit: str, **tags: str) -> None:
        text = json.dumps(
            {"table": self.table, **tags}, sort_keys=True, separators=(",", ":"), ensure_ascii=False
        )
        self.metrics.append((name, float(value), unit, text, self.now()))

    @contextmanager
    def timed(self, name: str):
        """Log a step with its duration; the body may set `rows` in the yielded dict.

        A step that fails is logged as such, and its error goes on to the caller.
        """
        begin, info = self.clock(), {}
        try:
            yield info
        except Exception as error:
            self.step(name, "failed", info.get("rows"), str(error), self.clock() - begin)
            raise
        seconds = self.clock() - begin
        self.metric(f"{name}_duration", seconds, "histogram")
        self.step(name, "success", info.get("rows"), None, seconds)

    def save(self, spark: SparkSession, root: str) -> None:
        logs.append_rows(spark, root, logs.RUN_LOG, logs.RUN_LOG_SCHEMA, self.steps)
        if self.metrics:
            logs.append_metrics(logs.few_rows(spark, self.metrics, logs.METRICS_SCHEMA), root)
