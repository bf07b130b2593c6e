"""Batch windows kept open in a stream's state.

Each group's open window is a list of files in the state store, with a timer at the time when the
window has ended and settled. New files cost what they are, whatever the stream has seen before:
neither the manifest nor the journal is read again. A closed window leaves the state as one row and
is ingested as one event, whose name depends on its files alone; so a micro-batch that is run again
after a crash finds its events done. A file that comes after its window was closed opens it again,
and is a window of its own as soon as a timer fires.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from siltworks.functions.naming import SourceFile, fnv1a
from siltworks.plans.ingest import Context, Outcome, ingest
from siltworks.plans.journal import Journal
from siltworks.plans.rule import Rule
from siltworks.sources.files import batch_windows
from siltworks.streaming.ingest import file_stream

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["dest", "group", "window_start", "window_end"]
CLOSED = "dest string, group string, window_start timestamp, window_end timestamp, files array<struct<modified:timestamp,url:string>>"


class OpenWindows(StatefulProcessor):
    """Files of one window of one group until it is due; `ahead` seconds sooner, to catch up."""

    def __init__(self, delay_seconds: int, ahead_seconds: int):
        self.late_ms = 1000 * (delay_seconds - ahead_seconds)

    def init(self, handle) -> None:
        self.handle = handle
        self.files = handle.getListState("files", "url string, modified timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for batch in rows:
            self.files.appendList([(r.url, r.modified.to_pydatetime()) for r in batch.itertuples()])
        due = int(pd.Timestamp(key[3]).timestamp() * 1000) + self.late_ms
        # a timer lies ahead of the clock, or it would never fire
        self.handle.registerTimer(max(due, timerValues.getCurrentProcessingTimeInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        files = sorted({(modified, url) for url, modified in self.files.get()})
        self.files.clear()
        if files:
            yield pd.DataFrame({"dest": [key[0]], "group": [key[1]], "window_start": [key[2]], "window_end": [key[3]], "files": [[{"modified": m, "url": u} for m, u in files]]})

    def close(self) -> None:
        pass


def closed_windows(files: DataFrame, rule: Rule, delay_seconds: int = 7, ahead_seconds: int = 0) -> DataFrame:
    """A stream of windows that have closed, from a stream of files (url, modified)."""
    if rule.roll_over:
        raise ValueError("windows that roll over are those of run_due")
    windows = batch_windows(files, rule.window_seconds, F.lit(rule.table), rule.multi_path, rule.pattern if rule.pattern_hash else None, False, rule.match.suffix)
    kept = windows.select(*KEYS, "url", "modified").groupBy(*KEYS)
    return kept.transformWithStateInPandas(OpenWindows(delay_seconds, ahead_seconds), CLOSED, "Append", "ProcessingTime")


def run_windows(spark: SparkSession, url: str, rule: Rule, checkpoint: str, journal: Journal, delay_seconds: int = 7, ahead_seconds: int = 0, max_files: int | None = None, trigger: dict | None = None, ran: list[Outcome] | None = None):
    """Start a query that ingests every window of a folder's files when it closes.

    The windows of a micro-batch reach the driver one by one, each with its files. `trigger` is
    that of a stream writer, by default {"availableNow": True}. Outcomes are appended to `ran`.
    """

    def take(batch: DataFrame, _: int) -> None:
        for row in batch.orderBy("window_end", "group").toLocalIterator():
            by_dest: dict[str, list[SourceFile]] = {}
            for f in row["files"]:
                file = SourceFile(f["url"], f["modified"].astimezone())
                by_dest.setdefault(rule.destination(file), []).append(file)
            for dest, own in sorted(by_dest.items()):
                mark = fnv1a("|".join([dest, *sorted(f"{f.url}@{f.modified.timestamp()}" for f in own)]))
                event = f"{row['group'][:12]}_{int(row['window_end'].timestamp())}_{abs(mark) % 10**12}"
                out = ingest(spark, rule, own, event, journal, Context(spark))
                if ran is not None:
                    ran.append(out)

    matched = file_stream(spark, url, max_files).where(rule.match.condition(F.col("url")))
    closed = closed_windows(matched, rule, delay_seconds, ahead_seconds)
    # a query keeps the settings that it starts with; other queries of the session have theirs
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return closed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
    finally:
        spark.conf.set(PROVIDER, old)
