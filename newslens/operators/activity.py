"""Ordered folds over events: circuit breakers, request rates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship

LIMIT, COOL_DOWN = 5, 300.0


def breaker_step(state: tuple[int, float], ts: float, ok: bool, limit: int = LIMIT, cool_down: float = COOL_DOWN) -> tuple[int, float]:
    """(failures, time of the last one) after an event: a failure adds one, a success takes one away, and an open breaker starts anew when it is looked at more than cool_down seconds after the last failure."""
    failures, last = state
    if failures >= limit and ts - last > cool_down:
        failures = 0
    return (max(failures - 1, 0), last) if ok else (failures + 1, ts)


def breaker_states(events: DataFrame, key: str = "domain", limit: int = LIMIT, cool_down: float = COOL_DOWN) -> DataFrame:
    """(key, failures, is_open): the breaker of each key after its events (ts in seconds, ok, ident for ties).

    The fold goes through sorted partitions row by row, so a key with most of
    the events is a long task but never held in memory.
    """
    ship(events.sparkSession)
    rows = events.select(key, F.col("ts").cast("double").alias("ts"), "ident", F.col("ok").cast("boolean").alias("ok")).repartition(key).sortWithinPartitions(key, "ts", "ident")
    schema = T.StructType([T.StructField(key, events.schema[key].dataType), T.StructField("failures", T.LongType()), T.StructField("is_open", T.BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: object = None
        state, begun = (0, 0.0), False
        for batch in batches:
            done = []
            for name, ts, ok in zip(batch[key], batch["ts"], batch["ok"], strict=True):
                name = None if pd.isna(name) else name
                if not begun or name != at:
                    if begun:
                        done.append((at, state[0], state[0] >= limit))
                    at, state, begun = name, (0, 0.0), True
                state = breaker_step(state, ts, bool(ok), limit, cool_down)
            if done:
                yield pd.DataFrame(done, columns=[key, "failures", "is_open"])
        if begun:
            yield pd.DataFrame([(at, state[0], state[0] >= limit)], columns=[key, "failures", "is_open"])

    return rows.mapInPandas(run, schema)


#: Windows that one task counts in at least.
SPANS = 16


def requests_in_window(events: DataFrame, key: str, ts: str, seconds: int = 60) -> DataFrame:
    """events with in_window: how many of the key's events, this one included, came in the seconds up to it.

    A key's events are cut into spans of time that are counted apart; those of
    the last window of a span are copied to the next, to be counted there but not
    returned. So a key with most of the events is many tasks.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    span = F.floor(micros / (SPANS * width))
    copied = F.pmod(micros, F.lit(SPANS * width)) >= (SPANS - 1) * width
    places = F.filter(F.array(F.struct(span.alias("span"), F.lit(True).alias("own")), F.when(copied, F.struct((span + 1).alias("span"), F.lit(False).alias("own")))), lambda x: x.isNotNull())
    rows = events.withColumn("_micros", micros).withColumn("_place", F.explode(places))
    order = Window.partitionBy(key, "_place.span").orderBy("_micros").rangeBetween(-width + 1, 0)
    return rows.withColumn("in_window", F.count(F.lit(1)).over(order)).where("_place.own").drop("_micros", "_place")
