"""Seconds of a run's stages: measured on the driver, kept as rows."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "run_id string, target_date string, tier string, entries long, stage string, place int, seconds double"


class Timings:
    """``with timings.stage("dedupe"):`` around each stage; stages of the same name add up."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.perf_counter() - began

    def rows(self, spark: SparkSession, run_id: str, day: str, tier: str, entries: int) -> DataFrame:
        return spark.createDataFrame([(run_id, day, tier, entries, name, k, seconds) for k, (name, seconds) in enumerate(self.seconds.items())], SCHEMA)


def append(rows: DataFrame, path: str) -> None:
    """Add a run's rows to the log, JSON lines."""
    rows.coalesce(1).write.mode("append").json(path)


def as_text(seconds: dict[str, float]) -> str:
    """Minutes and seconds of each stage, a line each, names filled up with dots."""
    return "\n".join(f"{name:.<30} {int(s // 60)}m {s % 60:05.2f}s" for name, s in seconds.items())
