"""Continuous ingestion: a file stream fills a manifest, closed windows are ingested.

The file source's checkpoint sees every file once. Micro-batches only append to the manifest
table, since a batch may end in the middle of a window; `run_due` takes the windows that have
closed and settled and hands each to the rule, once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.naming import SourceFile
from siltworks.operators import publish
from siltworks.plans.ingest import Context, Journal, Outcome, ingest
from siltworks.plans.rule import Rule
from siltworks.sources.files import MANIFEST, batch_windows, due_windows, unprocessed


def file_stream(spark: SparkSession, url: str, max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """url, modified and size of new files as a stream; no content is read."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(url).select(F.col("path").alias("url"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def collect_manifest(spark: SparkSession, url: str, rule: Rule, table: str, checkpoint: str, max_files: int | None = None):
    """Append the rule's new files to the manifest table, then stop (trigger availableNow)."""
    if not publish.exists(spark, table):
        publish.create(spark, table, T._parse_datatype_string(MANIFEST))

    def add(batch: DataFrame, _: int) -> None:
        known = batch.sparkSession.table(table)
        unprocessed(batch, known).write.insertInto(table)

    matched = file_stream(spark, url, max_files).where(rule.match.condition(F.col("url")))
    return matched.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_due(spark: SparkSession, rule: Rule, table: str, now: Column, journal: Journal, ctx: Context | None = None, delay_seconds: int = 7) -> list[Outcome]:
    """Ingest every closed window that the journal doesn't have; one row a window reaches the driver.

    A file that arrives after its window ran is a new run of that window with the late file
    alone: files of finished runs are left out of the manifest first.
    """
    spark.catalog.refreshTable(table)  # the stream writes it from a session of its own
    done = journal.latest().where("state = 'done'").select(F.explode("urls").alias("url")).distinct()
    files = spark.table(table).join(done, "url", "left_anti")
    windows = batch_windows(files, rule.window_seconds, F.lit(rule.table), rule.multi_path, rule.pattern if rule.pattern_hash else None, rule.roll_over, rule.match.suffix)
    out = []
    for row in due_windows(windows, now, delay_seconds).orderBy("window_end", "group").toLocalIterator():
        members = [SourceFile(f["url"], _aware(f["modified"])) for f in row["files"]]
        by_dest: dict[str, list[SourceFile]] = {}
        for m in members:
            by_dest.setdefault(rule.destination(m), []).append(m)
        for dest, own in sorted(by_dest.items()):
            event = f"{row['group'][:12]}_{int(row['window_end'].timestamp())}_{abs(hash_of(dest, own)) % 10**8}"
            out.append(ingest(spark, rule, own, event, journal, ctx))
    return out


def hash_of(dest: str, files: list[SourceFile]) -> int:
    from siltworks.functions.naming import fnv1a

    return fnv1a("|".join([dest, *sorted(f.url for f in files)]))


def _aware(t: datetime) -> datetime:
    return t.astimezone() if t.tzinfo is None else t


def windowed_counts(events: DataFrame, at: str, seconds: int, late_seconds: int, by: list[str]) -> DataFrame:
    """Counts of a stream (or table) by tumbling window, under a watermark for late events."""
    return (
        events.withWatermark(at, f"{late_seconds} seconds")
        .groupBy(F.window(at, f"{seconds} seconds").alias("window"), *by)
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "count")
    )
