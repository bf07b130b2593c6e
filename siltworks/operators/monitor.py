"""Metrics over manifests, jobs, errors and reports, each an aggregate over its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERRORS_SHOWN = 40
LONG_RUNNING_SHOWN = 100
STALLED_SHOWN = 1_000
STALLED_SECONDS = 90 * 60


def event_metrics(events: DataFrame, by: list[str], at: str, now: Column) -> DataFrame:
    """Count, first, last and lag in seconds (now less the first) for each destination."""
    out = events.groupBy(*by).agg(F.count("*").alias("count"), F.min(at).alias("first"), F.max(at).alias("last"))
    lag = F.abs(F.unix_timestamp(now) - F.unix_timestamp(F.col("first").cast("timestamp")))
    return out.withColumn("lag_sec", lag)


def staged_metrics(events: DataFrame, dest: str, stage: str, at: str) -> DataFrame:
    """For each destination its count and an array of counts by stage, in order of stage."""
    stages = events.groupBy(dest, stage).agg(F.count("*").alias("count"), F.min(at).alias("first"), F.max(at).alias("last"))
    each = F.struct(F.col(stage).alias("stage"), "count", "first", "last")
    return stages.groupBy(dest).agg(F.sum("count").alias("count"), F.array_sort(F.collect_list(each)).alias("stages"))


def state_counts(jobs: DataFrame, by: str, state: str, states: list[str]) -> DataFrame:
    """Number of jobs by state for each project, a column for each state."""
    return jobs.groupBy(by).agg(*[F.count_if(F.col(state) == s).alias(f"n_{s}") for s in states])


def throttled(counts: DataFrame, active: str, limit: int) -> DataFrame:
    """Projects with the number of jobs that may still start under a limit."""
    return counts.withColumn("open", F.greatest(F.lit(0), F.lit(limit) - F.col(active))).withColumn("throttled", F.col(active) >= limit)


def select_jobs(jobs: DataFrame, kind: str | None = None, source: str | None = None, dest: str | None = None) -> DataFrame:
    """Jobs of a type whose source and destination match patterns; what isn't given always matches."""
    if kind:
        jobs = jobs.where(F.lower("job_type") == kind.lower())
    if source:
        jobs = jobs.where(F.col("source").rlike(source))
    if dest:
        jobs = jobs.where(F.col("dest").rlike(dest))
    return jobs


def pending_states(tasks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Pending tasks with the state of their job, or not_found."""
    return tasks.join(jobs.select("job_id", "state"), "job_id", "left").withColumn("state", F.coalesce("state", F.lit("not_found")))


def stalled(files: DataFrame, now: Column, seconds: int = STALLED_SECONDS) -> DataFrame:
    """Numbers of active and stalled files in each folder."""
    old = F.unix_timestamp(now) - F.unix_timestamp("modified") > seconds
    folder = F.regexp_extract("url", r"^(.*)/[^/]*$", 1).alias("folder")
    return files.groupBy(folder).agg(F.count_if(~old).alias("active"), F.count_if(old).alias("stalled"))


def stalled_files(files: DataFrame, now: Column, seconds: int = STALLED_SECONDS) -> DataFrame:
    """The oldest stalled files, a report of bounded length."""
    return files.where(F.unix_timestamp(now) - F.unix_timestamp("modified") > seconds).orderBy("modified", "url").limit(STALLED_SHOWN)


def first_errors(errors: DataFrame, dest: str, order: list[str], shown: int = ERRORS_SHOWN) -> DataFrame:
    """The first errors of each destination."""
    w = Window.partitionBy(dest).orderBy(*order)
    return errors.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= shown)


def recent(events: DataFrame, at: str, now: Column, seconds: int) -> DataFrame:
    return events.where(F.col(at) >= now - F.expr(f"interval {int(seconds)} seconds"))


def latest(reports: DataFrame, at: str, tie: str) -> DataFrame:
    return reports.orderBy(F.desc(at), tie).limit(1)


def long_running(processes: DataFrame, now: Column, seconds: int) -> DataFrame:
    late = processes.where(F.unix_timestamp(now) - F.unix_timestamp("started") > seconds)
    return late.orderBy("started", "event_id").limit(LONG_RUNNING_SHOWN)


def sum_in_array(array: str, field: str) -> Column:
    """Sum of a field over an array of structs; 0 for an empty array, null for null."""
    return F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x[field].cast("long"), F.lit(0).cast("long")))


def load_report(states: DataFrame, loads: DataFrame, now: Column) -> DataFrame:
    """One row: totals of all events, and for each destination its events by state, rows and files.

    `states` has the latest state of each event (event_id, rule, dest, state, at, error), `loads` what
    each load counted (event_id, dest, rows, files with url and kind). Both are aggregates by
    destination before they meet, and the report is as long as there are destinations.
    """
    part = lambda *names: F.struct(
        F.count_if(F.col("state").isin(*names)).alias("count"), F.min(F.when(F.col("state").isin(*names), F.col("at"))).alias("first"), F.max(F.when(F.col("state").isin(*names), F.col("at"))).alias("last")
    )
    by_dest = states.groupBy("dest").agg(
        F.max("rule").alias("rule"), part("running", "published").alias("running"), part("done").alias("done"), part("failed").alias("failed"), F.max_by("error", "at").alias("error")
    )
    oldest = F.unix_timestamp(now) - F.unix_timestamp("running.first")
    kinds = ("valid", "corrupted", "invalid_schema", "missing")
    of = lambda kind: F.sum(F.size(F.filter("files", lambda f: f["kind"] == kind))).alias(f"n_{kind}")
    counted = loads.groupBy("dest").agg(F.sum("rows").alias("rows"), *[of(k) for k in kinds])
    whole = by_dest.withColumn("lag_sec", oldest).join(counted, "dest", "left")
    each = F.struct("dest", "rule", "running", "done", "failed", "error", "lag_sec", "rows", *[f"n_{k}" for k in kinds])
    return whole.agg(
        F.sum("running.count").alias("n_running"), F.sum("done.count").alias("n_done"), F.sum("failed.count").alias("n_failed"), F.sum("rows").alias("rows"), F.array_sort(F.collect_list(each)).alias("dests")
    ).withColumn("at", now)
