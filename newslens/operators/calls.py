"""Calls of a language model from Spark tasks: a shared rate, attempts with waits, a second model, and a summary without a model at last."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import with_computed
from .models import ATTEMPTS, WAIT, ModelRegistry

#: Calls that all tasks together may make within WINDOW seconds.
PER_WINDOW, WINDOW = 600, 60.0
METHODS = ("model", "fallback", "extractive")


class Pacer:
    """Lets calls through as long as no more than ``limit`` lie within any ``window`` seconds; the others wait."""

    def __init__(self, limit: int, window: float = WINDOW, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        if limit < 1:
            raise ValueError("a pacer needs room for a call")
        self.limit, self.window, self.clock, self.sleep = limit, window, clock, sleep
        self.calls: deque[float] = deque()

    def wait(self) -> None:
        while True:
            now = self.clock()
            while self.calls and self.calls[0] <= now - self.window:
                self.calls.popleft()
            if len(self.calls) < self.limit:
                self.calls.append(now)
                return
            self.sleep(max(0.0, self.calls[0] + self.window - now) + 1e-3)


def called(text: str | None, first: Callable[[pd.Series], pd.Series], second: Callable[[pd.Series], pd.Series] | None, attempts: int, wait: float, pacer: Pacer | None = None, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int]:
    """(result, method, attempts made): the last attempt is the second model's if there is one; waits double. A failure or an empty result counts as none."""
    for k in range(attempts):
        last = k == attempts - 1 and second is not None
        if k:
            sleep(wait * 2 ** (k - 1))
        if pacer is not None:
            pacer.wait()
        try:
            result = (second if last else first)(pd.Series([text])).iloc[0]
        except (OSError, ValueError, RuntimeError):
            continue
        if isinstance(result, str) and result.strip():
            return result, METHODS[last], k + 1
    return None, None, attempts


def summarised(rows: DataFrame, registry: ModelRegistry, text: str = "prompt", extractive: str = "extractive", limit: int = PER_WINDOW, window: float = WINDOW, attempts: int = ATTEMPTS, wait: float = WAIT, most_tasks: int = 16) -> DataFrame:
    """rows with summary, summary_method (of METHODS) and attempts.

    Each of at most ``most_tasks`` tasks has its share of the rate as a lease, so
    all of them together keep to it; a task that is tried again first lets the
    window of its last try pass. Rows whose calls all fail, and all rows where no
    model is registered, get the text in ``extractive``, at no call.

    Defined results: null texts are passed to the model as such; an empty table
    gives no rows; other columns go through unchanged.
    """
    first, second = registry.held["summary"][0], registry.held["summary_fallback"][0]
    if first is None and second is None:
        return rows.withColumns({"summary": F.col(extractive), "summary_method": F.lit("extractive"), "attempts": F.lit(0)})
    tasks = max(1, min(most_tasks, limit))
    leased = limit // tasks
    held: dict[str, Pacer] = {}

    def run(texts: list) -> list[list]:
        if "pacer" not in held:
            held["pacer"] = Pacer(leased, window)
            if TaskContext.get() is not None and TaskContext.get().attemptNumber():
                time.sleep(window)
        found = [called(x, first or second, second, attempts, wait, held["pacer"]) for x in texts]
        return [list(x) for x in zip(*found, strict=True)] if found else [[], [], []]

    added = T.StructType([T.StructField("summary", T.StringType()), T.StructField("summary_method", T.StringType()), T.StructField("attempts", T.IntegerType())])
    out = with_computed(rows.repartition(tasks), text, run, added)
    return out.withColumns({"summary": F.coalesce("summary", F.col(extractive)), "summary_method": F.coalesce("summary_method", F.lit("extractive"))})
