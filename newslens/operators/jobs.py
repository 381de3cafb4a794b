"""Job and run tracking: selection, claims, state changes and the reports of operations.

Change operators return the new rows of the table; writing them is
sources.catalog's part. Times come in as literals, so a run can be repeated.
"""

from __future__ import annotations

import secrets
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import error_text
from ..schema import READY, RUN_STATUSES, TERMINAL

LIGHT = ("id", "flashpoint_id", "url", "title", "language", "domain", "sourcecountry")


def unprocessed(entries: DataFrame, jobs: DataFrame, run_id: str, limit: int | None = 1000) -> DataFrame:
    """Entries of a flashpoint that no run has finished and this run hasn't taken, light columns, in order of arrival."""
    done = jobs.where(F.col("status").isin(*TERMINAL)).select(F.col("feed_entry_id").alias("id"))
    taken = jobs.where(F.col("run_id") == run_id).select(F.col("feed_entry_id").alias("id"))
    rows = entries.where("flashpoint_id is not null").join(done, "id", "left_anti").join(taken, "id", "left_anti")
    out = rows.select(*LIGHT, F.col("content").isNotNull().alias("has_content"), "seq")
    return (out.orderBy("seq", "id").limit(limit) if limit is not None else out).drop("seq")


def content_batch(entries: DataFrame, ids: DataFrame) -> DataFrame:
    """The heavy columns of the wanted ids."""
    return entries.join(ids.select("id").distinct(), "id", "left_semi").select("id", "content", "description")


def resume_merge(entries: DataFrame, heavy: DataFrame) -> DataFrame:
    """Light rows with what is stored for them, empty where nothing is."""
    return entries.join(heavy, "id", "left").withColumn("content", F.coalesce("content", F.lit("")))


def entries_of_run(entries: DataFrame, jobs: DataFrame, run_id: str, statuses: tuple[str, ...] = READY) -> DataFrame:
    """Entries with this run's job in one of the statuses and not a duplicate, with the status."""
    own = jobs.where((F.col("run_id") == run_id) & F.col("status").isin(*statuses) & ~F.col("is_duplicate")).select(F.col("feed_entry_id").alias("id"), "status")
    return entries.join(own, "id")


def flashpoints_of_run(entries: DataFrame, jobs: DataFrame, run_id: str) -> DataFrame:
    """Flashpoints that have an entry in the run that neither failed nor is a duplicate."""
    live = jobs.where((F.col("run_id") == run_id) & (F.col("status") != "failed") & ~F.col("is_duplicate")).select(F.col("feed_entry_id").alias("id"))
    return entries.where("flashpoint_id is not null").join(live, "id", "left_semi").select("flashpoint_id").distinct()


def claim(entries: DataFrame, jobs: DataFrame, run_id: str) -> DataFrame:
    """The jobs to insert: one per entry that has none in the run, fetching, at its first attempt."""
    held = jobs.where(F.col("run_id") == run_id).select(F.col("feed_entry_id").alias("id"))
    return entries.select("id").distinct().join(held, "id", "left_anti").select(F.col("id").alias("feed_entry_id"), F.lit(run_id).alias("run_id"), F.lit("fetching").alias("status"), F.lit(1).alias("attempts"))


def transition(jobs: DataFrame, changes: DataFrame) -> DataFrame:
    """jobs with status and last_error of changes (feed_entry_id, run_id, new_status, error); errors are cut."""
    new = changes.select("feed_entry_id", "run_id", "new_status", "error")
    joined = jobs.join(new, ["feed_entry_id", "run_id"], "left")
    return joined.withColumn("status", F.coalesce("new_status", "status")).withColumn("last_error", error_text(F.col("error"))).drop("new_status", "error")


def run_id(at: datetime, mark: str | None = None) -> str:
    """run_, the day, the second and eight hexadecimal digits, random if not given."""
    return f"run_{at:%Y%m%d_%H%M%S}_{mark or secrets.token_hex(4)}"


def create_run(runs: DataFrame, ident: str, tier: str, day: str | None, at: Column) -> DataFrame:
    """runs with a new one, pending from the time given; other columns are null. ValueError if there is one of that id."""
    if runs.where(F.col("run_id") == ident).limit(1).count():
        raise ValueError(f"run {ident} exists")
    given = {"run_id": F.lit(ident), "status": F.lit("pending"), "pipeline_tier": F.lit(tier), "target_date": F.lit(day), "started_at": at}
    new = runs.sparkSession.range(1).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in runs.schema])
    return runs.unionByName(new)


def update_run(runs: DataFrame, ident: str, status: str, **changes: Column) -> DataFrame:
    """runs with the status, and other columns, of one changed."""
    if status not in RUN_STATUSES:
        raise ValueError(status)
    own = F.col("run_id") == ident
    kinds = {f.name: f.dataType for f in runs.schema}
    new = {"status": F.lit(status), **changes}
    return runs.withColumns({name: F.when(own, value.cast(kinds[name])).otherwise(F.col(name)) for name, value in new.items()})


def complete_run(runs: DataFrame, ident: str, metrics: str, at: Column) -> DataFrame:
    """runs with one completed at the time given, with its metrics."""
    return update_run(runs, ident, "completed", completed_at=at, metrics=F.lit(metrics))


def active_runs(runs: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    """One row: how many runs are running and began within the hours."""
    return runs.where((F.col("status") == "running") & (F.col("started_at") >= as_of - F.make_dt_interval(hours=F.lit(hours)))).agg(F.count(F.lit(1)).alias("active"))


def fail_stale(runs: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    """runs with those that have run for longer than the hours marked failed; ``was_stale`` tells which."""
    stale = (F.col("status") == "running") & (F.col("started_at") < as_of - F.make_dt_interval(hours=F.lit(hours)))
    return runs.withColumn("was_stale", stale).withColumn("status", F.when(stale, "failed").otherwise(F.col("status")))


def purge_failed(jobs: DataFrame, run_id: str) -> DataFrame:
    """jobs without the run's failed ones, so that they can be claimed again."""
    return jobs.where(~((F.col("run_id") == run_id) & (F.col("status") == "failed")))


def run_stats(jobs: DataFrame, run_id: str) -> DataFrame:
    return jobs.where(F.col("run_id") == run_id).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def run_metrics(jobs: DataFrame, run_id: str, tier: str, day: str) -> DataFrame:
    """One row for the run's record: its counts by status as JSON."""
    stats = run_stats(jobs, run_id).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("stats"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_entries"))
    return stats.select(F.lit(run_id).alias("run_id"), F.to_json(F.struct("total_entries", "stats", F.lit(tier).alias("tier"), F.lit(day).alias("target_date"))).alias("metrics"))


def latest_jobs(jobs: DataFrame, order: str) -> DataFrame:
    """The last job of each entry."""
    return jobs.withColumn("_rn", F.row_number().over(Window.partitionBy("feed_entry_id").orderBy(F.desc(order), F.desc("run_id")))).where("_rn = 1").drop("_rn")


def health(jobs: DataFrame, clusters: DataFrame, run_id: str) -> DataFrame:
    """One row of percentages (failed jobs, failed extractions, clusters of one article), each with its level."""
    own = jobs.where(F.col("run_id") == run_id)
    share = lambda cond: F.round(100.0 * F.count_if(cond) / F.nullif(F.count(F.lit(1)), F.lit(0)), 1)
    found = own.agg(share(F.col("status") == "failed").alias("failed_pct"), share(F.col("failure_reason") == "no_text").alias("extraction_failed_pct"))
    sizes = clusters.agg(share(F.col("article_count") == 1).alias("singleton_pct"))
    level = lambda c, warn, bad: F.when(F.col(c) > bad, "critical").when(F.col(c) > warn, "warn").otherwise("ok")
    return found.crossJoin(sizes).select("*", level("failed_pct", 10, 25).alias("failed_level"), level("extraction_failed_pct", 20, 40).alias("extraction_level"), level("singleton_pct", 60, 80).alias("singleton_level"))
