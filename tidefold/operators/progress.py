"""How far the mirror is, and how long its stages take."""

from __future__ import annotations

import time
from collections import defaultdict
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import Lake

# The stages of a batch that are timed.
STAGES = ("decode", "plan", "lock_wait", "ensure", "staging_ddl", "append", "mirror_dml", "lake_commit", "cleanup", "offset_ack")


@dataclass
class SyncState:
    """Counters and gauges of one source, and a timing row per stage and batch."""

    source: str
    counts: dict = field(default_factory=lambda: defaultdict(int))
    source_commit_ms: int = 0
    delivered_ms: int = 0
    batch_ms: int = 0
    timings: list = field(default_factory=list)

    def delivered(self, commit_ms: int | None, now_ms: int | None = None) -> None:
        """A source transaction arrived; the source's clock never runs back here."""
        self.source_commit_ms = max(self.source_commit_ms, commit_ms or 0)
        self.delivered_ms = now_ms if now_ms is not None else int(time.time() * 1000)

    @property
    def lag_ms(self) -> int:
        return max(0, self.delivered_ms - self.source_commit_ms) if self.source_commit_ms > 0 else 0

    def committed(self, events: int, stages: dict[str, float] | None = None, now_ms: int | None = None) -> None:
        """A batch was published; one without events (DDL alone) counts as a batch too."""
        self.counts["batches"] += 1
        self.counts["events"] += events
        self.batch_ms = now_ms if now_ms is not None else int(time.time() * 1000)
        for stage, ms in (stages or {}).items():
            if stage not in STAGES:
                raise ValueError(f"unknown stage {stage}")
            self.timings.append((self.source, self.counts["batches"], stage, max(0.0, float(ms))))

    def filtered(self, commit_ms: int | None, now_ms: int | None = None) -> None:
        """A transaction without captured rows: it moves the clock, not the counters of events."""
        self.counts["filtered"] += 1
        self.delivered(commit_ms, now_ms)

    def failed(self) -> None:
        self.counts["failures"] += 1

    @contextmanager
    def timed(self, stages: dict[str, float], name: str):
        began = time.perf_counter()
        try:
            yield
        finally:
            stages[name] = stages.get(name, 0.0) + (time.perf_counter() - began) * 1000

    def timing_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.timings, "source string, batch long, stage string, ms double")


def percentiles(timings: DataFrame) -> DataFrame:
    """source, stage, batches, p50, p95 of timing rows."""
    return timings.groupBy("source", "stage").agg(
        F.count(F.lit(1)).alias("batches"), F.percentile("ms", F.lit(0.5)).alias("p50"), F.percentile("ms", F.lit(0.95)).alias("p95")
    )


def watermark(lake: Lake, state: SyncState) -> DataFrame:
    """One row: where the source, the delivery and the lake stand."""
    manifest = lake.manifest()
    snapshot_ms = int(manifest["ts"] * 1000)
    row = (
        state.source, manifest["version"], snapshot_ms, state.source_commit_ms, state.delivered_ms, state.lag_ms, state.counts["events"],
        state.counts["batches"], state.counts["failures"], state.counts["ddl_applied"], str(manifest["offsets"].get(state.source)),
    )
    schema = "source string, version long, snapshot_ms long, source_commit_ms long, delivered_ms long, lag_ms long, events long, batches long, failures long, ddl_applied long, offset string"
    return lake.spark.createDataFrame([row], schema)
