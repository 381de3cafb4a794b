"""Structured Streaming forms of batch operators."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.text import content_hash
from ..operators.activity import COOL_DOWN, LIMIT, breaker_step


def tumbling_counts(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """(start, event_type, n) per window; on a stream put a watermark on ts first."""
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sliding_counts(events: DataFrame, width: str = "1 hour", step: str = "15 minutes") -> DataFrame:
    return events.groupBy(F.window("ts", width, step).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def session_counts(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def dedupe_stream(entries: DataFrame, ts: str, delay: str, text: str = "text") -> DataFrame:
    """The first entry of each content hash within the watermark."""
    return entries.withColumn("content_hash", content_hash(F.col(text))).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["content_hash"])


#: Where a job may go from each state.
STEPS = {"queued": ("fetching",), "fetching": ("extracted", "failed"), "extracted": ("deduped", "embedded", "skipped_duplicate", "failed"), "deduped": ("embedded", "failed"), "embedded": ("clustered", "summarized", "failed"), "clustered": ("summarized", "failed"), "summarized": ("scored",)}


def job_states(changes: DataFrame, key: str = "feed_entry_id") -> DataFrame:
    """A stream of (key, status, n): the state of each job after its changes; changes that the state doesn't allow are ignored.

    changes: a stream with the key (long), status and seq, its order.
    """

    def step(keys: tuple[Any, ...], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        status, n = state.get if state.exists else ("queued", 0)
        for row in pd.concat(list(batches)).sort_values("seq").itertuples(index=False):
            if row.status in STEPS.get(status, ()):
                status, n = row.status, n + 1
        state.update((status, n))
        yield pd.DataFrame({key: [keys[0]], "status": [status], "n": [n]})

    return changes.groupBy(key).applyInPandasWithState(step, f"{key} long, status string, n long", "status string, n long", "update", "NoTimeout")


#: States that a job may not stay in for long, and for how many seconds.
STUCK, STUCK_AFTER = ("fetching",), 2 * 3600.0


def job_step(held: tuple[str, int, float], status: str, at: float, limit: float = STUCK_AFTER) -> tuple[str, int, float]:
    """(status, changes, since) of a job after a change at a time, in seconds: a job that was stuck for longer than the limit has failed by then."""
    held = job_expiry(held, at, limit)
    return (status, held[1] + 1, at) if status in STEPS.get(held[0], ()) else held


def job_expiry(held: tuple[str, int, float], at: float, limit: float = STUCK_AFTER) -> tuple[str, int, float]:
    """The job at a time without a change: failed if it is stuck for longer than the limit."""
    return ("failed", held[1] + 1, held[2] + limit) if held[0] in STUCK and at > held[2] + limit else held


class _TimedJobs(StatefulProcessor):
    """Jobs by key; a timer for each one that may be stuck, at the time by which it fails."""

    def __init__(self, key: str, limit: float) -> None:
        self.key, self.limit = key, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("job", "status string, n long, since double")

    def _row(self, keys: tuple[Any, ...], held: tuple[str, int, float]) -> pd.DataFrame:
        return pd.DataFrame({self.key: [keys[0]], "status": [held[0]], "n": [held[1]]})

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.held.get()) if self.held.exists() else ("queued", 0, 0.0)
        changes = pd.concat(list(rows))
        changes = changes.assign(at=changes.ts.astype("datetime64[us]").astype("int64") / 1e6).sort_values(["at", "seq"])
        for row in changes.itertuples(index=False):
            held = job_step(held, row.status, row.at, self.limit)
        self.held.update(held)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if held[0] in STUCK:
            self.handle.registerTimer(int((held[2] + self.limit) * 1000) + 1)
        yield self._row(key, held)

    def handleExpiredTimer(self, key: tuple[Any, ...], timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        before = tuple(self.held.get())
        held = job_expiry(before, expiredTimerInfo.getExpiryTimeInMs() / 1000, self.limit)
        if held != before:
            self.held.update(held)
            yield self._row(key, held)

    def close(self) -> None:
        pass


def timed_job_states(changes: DataFrame, key: str = "feed_entry_id", delay: str = "10 minutes", limit: float = STUCK_AFTER) -> DataFrame:
    """As job_states, by event time: a job that stays in a STUCK state for longer than ``limit`` seconds becomes failed when the watermark has passed that time.

    changes: a stream with the key (long), status, ts (timestamp) and seq for
    ties; ``delay`` is how late they may come. The session's state store has to
    be RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    schema = changes.select(key).schema
    out = StructType([*schema, StructField("status", StringType()), StructField("n", LongType())])
    return changes.withWatermark("ts", delay).groupBy(key).transformWithStateInPandas(_TimedJobs(key, limit), out, "Update", "EventTime")


def breaker_stream(events: DataFrame, key: str = "domain", limit: int = LIMIT, cool_down: float = COOL_DOWN) -> DataFrame:
    """A stream of (key, failures, is_open): each key's breaker after the events so far, folded as in activity.breaker_states.

    events: a stream with the key (string), ts in seconds, ident for ties, and ok.
    Events are in order within a micro-batch; one that comes later than its
    successors is folded when it comes.
    """

    def step(keys: tuple[Any, ...], batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (0, 0.0)
        for row in pd.concat(list(batches)).sort_values(["ts", "ident"]).itertuples(index=False):
            held = breaker_step(held, float(row.ts), bool(row.ok), limit, cool_down)
        state.update(held)
        yield pd.DataFrame({key: [keys[0]], "failures": [held[0]], "is_open": [held[0] >= limit]})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} string, failures long, is_open boolean", "failures long, last double", "update", "NoTimeout")


def request_rates(events: DataFrame, key: str, width: str = "60 seconds", step: str = "10 seconds") -> DataFrame:
    """(key, start, n): requests of each key in windows that slide; on a stream put a watermark on ts first."""
    return events.groupBy(key, F.window("ts", width, step).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), "n")


def write_idempotent(stream: DataFrame, path: str, by: list[str], checkpoint: str):
    """A query that replaces exactly the partitions of each micro-batch; a repeated batch changes nothing."""
    from ..sources.catalog import write_partitions

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: write_partitions(df, path, by)).start()
