"""What has been run: states of events, claims on them, and what each load took in."""

from __future__ import annotations

import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.operators import commit, publish
from siltworks.sources.recovery import Classified

STATES = "event_id string, rule string, dest string, state string, urls array<string>, at timestamp, error string"
FILE = "struct<url:string,kind:string>"
LOADS = f"event_id string, rule string, dest string, rows long, started timestamp, ended timestamp, files array<{FILE}>"
#: A journal of more files than this is compacted.
FILES = 200
#: Seconds after which a claim that nobody renewed may be taken over.
LEASE = 900


class LoadMetrics:
    """What a write counted of the rows that it read, without another look at them."""

    def __init__(self):
        self.seen, self.started = None, datetime.now(timezone.utc)

    def counted(self, rows: DataFrame) -> DataFrame:
        self.seen = Observation(f"load_{uuid.uuid4().hex}")
        return rows.observe(self.seen, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        return int(self.seen.get["rows"]) if self.seen is not None else 0


class Journal:
    """A table of runs; the latest row of an event is its state.

    Beside it lies a table of loads, with counts that the writes took themselves and the files by
    what became of them. Records of changes, claims and staged files are in folders of the table
    that readers pass over. Each state is a small file; beyond FILES of them they are put into
    one, in order of event, as one recorded change: readers see states twice at worst, never none.
    """

    def __init__(self, spark: SparkSession, table: str, files: int = FILES, lease: int = LEASE):
        self.spark, self.table, self.loads, self.most, self.lease = spark, table, f"{table}_loads", files, lease
        for name, schema in ((table, STATES), (self.loads, LOADS)):
            if not publish.exists(spark, name):
                publish.create(spark, name, T._parse_datatype_string(schema))
        self.folder = commit.location(spark, table)
        self.commits, self.owner, self.files = f"{self.folder}/{commit.RECORDS}", uuid.uuid4().hex, commit.Files(spark)
        self._put = 0

    def put(self, event_id: str, rule: str, dest: str, state: str, urls: list[str], error: str | None = None) -> None:
        row = (event_id, rule, dest, state, urls, datetime.now(timezone.utc), error)
        self.spark.createDataFrame([row], STATES).coalesce(1).write.insertInto(self.table)
        self._put += 1
        if self._put % max(1, self.most // 4) == 0:
            self.compact()

    def note_load(self, event_id: str, rule: str, dest: str, found: Classified, metrics: LoadMetrics) -> None:
        files = [{"url": u, "kind": k} for k in ("valid", "corrupted", "invalid_schema", "missing") for u in getattr(found, k)]
        row = (event_id, rule, dest, metrics.rows, metrics.started, datetime.now(timezone.utc), files)
        self.spark.createDataFrame([row], LOADS).coalesce(1).write.insertInto(self.loads)

    def compact(self) -> bool:
        """Put the files of both tables into few, if there are many; whether that was done."""
        done = False
        for table in (self.table, self.loads):
            base = commit.location(self.spark, table)
            record = commit.Commits(self.spark, f"{base}/{commit.RECORDS}")
            for name in self.files.data(record.folder) if self.files.exists(record.folder) else []:
                if name.startswith("compact-"):  # of a driver that was lost
                    record.finish(record.find(name.removesuffix(".json")))
                    record.forget(name.removesuffix(".json"))
            there = self.files.data(base)
            if len(there) <= self.most:
                continue
            staged = commit.staging_folder(self.spark, table)
            rows = self.spark.read.schema(self.spark.table(table).schema).parquet(*[f"{base}/{f}" for f in there])
            rows.sortWithinPartitions("event_id").write.option("parquet.bloom.filter.enabled#event_id", "true").parquet(staged)
            event = f"compact-{uuid.uuid4().hex}"
            record.publish(event, [commit.Change(table, staged, self.files.data(staged), there, f"{event}-")])
            record.forget(event)
            done = True
        return done

    def latest(self) -> DataFrame:
        rows = self.spark.table(self.table)
        return rows.groupBy("event_id").agg(F.max_by(F.struct("rule", "dest", "state", "urls", "at", "error"), "at").alias("x")).select("event_id", "x.*")

    def done(self, event_id: str) -> bool:
        self.spark.catalog.refreshTable(self.table)
        return not self.spark.table(self.table).where((F.col("event_id") == event_id) & (F.col("state") == "done")).isEmpty()

    def replay(self, older_than: datetime) -> DataFrame:
        """Runs that began before a time and never ended; those published want their actions only."""
        return self.latest().where(F.col("state").isin("running", "published") & (F.col("at") < F.lit(older_than)))

    def claim(self, event_id: str) -> bool:
        """Take an event for this driver; False while another has it. A claim lasts for the lease."""
        at = f"{self.folder}/_claims/{event_id}.json"
        mine = json.dumps({"owner": self.owner, "until": time.time() + self.lease})
        if self.files.create(at, mine):
            return True
        held = json.loads(self.files.read(at) or "{}")
        if held.get("owner") == self.owner:
            return True
        if held.get("until", 0) > time.time():
            return False
        # a lost driver's: one of those who see that moves it away, and then all try again
        aside = f"{self.folder}/_claims/.{uuid.uuid4().hex}"
        fs, path = self.files.of(at)
        try:
            if not fs.rename(path, self.files.path(aside)):
                return False
        except Exception:  # gone meanwhile
            return False
        self.files.delete(aside)
        return self.files.create(at, mine)

    def release(self, event_id: str) -> None:
        at = f"{self.folder}/_claims/{event_id}.json"
        if json.loads(self.files.read(at) or "{}").get("owner") == self.owner:
            self.files.delete(at)

