"""Publishing to several tables as one step.

Rows are first written to folders that no table reads. Then one small record, created in a single
rename, says which of these files go to which tables and which files of the tables go for them.
From then on the change is made: what is left is moving files, and whoever finds the record can
finish that, however often it was begun. Before the record there is nothing to see of the change.

A table's files are moved, not written again, so a split writes its rows once.
"""

from __future__ import annotations

import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.operators import publish

APPEND, OVERWRITE, PARTITIONS, TOUCHED = "append", "overwrite", "partitions", "touched"
#: Folders and records of changes; readers pass over names with a leading underscore.
STAGING, RECORDS = "_staging", "_commits"


class Files:
    """File operations through Spark's own file systems."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, spark._jvm.org.apache.hadoop.fs.Path

    def of(self, url: str):
        path = self.path(url)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, url: str) -> bool:
        fs, path = self.of(url)
        return fs.exists(path)

    def delete(self, url: str) -> None:
        fs, path = self.of(url)
        fs.delete(path, True)

    def data(self, url: str) -> list[str]:
        """Paths below a folder, relative to it, of files that readers see, in order."""
        fs, path = self.of(url)
        if not fs.exists(path):
            return []
        base, out, found = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/", [], fs.listFiles(path, True)
        while found.hasNext():
            name = found.next().getPath().toUri().getPath().removeprefix(base)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                out.append(name)
        return sorted(out)

    def move(self, source: str, dest: str) -> None:
        """Rename, also if that has been done before."""
        fs, to = self.of(dest)
        if not fs.exists(to):
            fs.mkdirs(to.getParent())
            if not fs.rename(self.path(source), to) and not fs.exists(to):
                raise OSError(f"{source} can't be moved to {dest}")

    def read(self, url: str) -> str | None:
        fs, path = self.of(url)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, url: str, text: str) -> bool:
        """Create a file with all its content or not at all; False if it is there already."""
        fs, path = self.of(url)
        aside = self.path(f"{url.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        fs.mkdirs(path.getParent())
        stream = fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(path) or not fs.rename(aside, path):
            fs.delete(aside, False)
            return False
        return True


@dataclass
class Change:
    """Files that a table gets, from a staged folder, and the files of it that go for them."""

    table: str
    staged: str
    moves: list[str]
    removes: list[str] = field(default_factory=list)
    #: What stands in front of moved files' names, so that no other change has the same.
    mark: str = ""
    #: Required columns that these rows have nulls in, which the table takes from now on.
    relaxes: list[str] = field(default_factory=list)


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def staging_folder(spark: SparkSession, table: str) -> str:
    return f"{location(spark, table)}/{STAGING}/{uuid.uuid4().hex}"


def _partition(path: str) -> tuple[str, ...]:
    return tuple(path.split("/")[:-1])


def _removed(spark: SparkSession, table: str, moves: list[str], mode: str, touched: set[tuple[str, ...]] = frozenset()) -> list[str]:
    if mode == APPEND:
        return []
    there = Files(spark).data(location(spark, table))
    if mode == OVERWRITE:
        return there
    own = touched | ({_partition(m) for m in moves} if mode == PARTITIONS else set())
    return [f for f in there if _partition(f) in own]


def stage(rows: DataFrame, table: str, mode: str = APPEND, only: dict[str, object] | None = None, touched: DataFrame | None = None, relax: bool = False) -> Change:
    """Write rows as a table has them to a folder beside its files; creates a missing table.

    With mode PARTITIONS, partitions that rows are of are replaced, and those that `touched` names
    (in the table's partition columns) too; with TOUCHED only the latter are, and other rows are
    added. Of a table without partitions any row of `touched` stands for all. Nulls in required
    columns fail the write, or with `relax` are counted by it and relax the column. With `only`, a row of another partition fails it.
    """
    spark = rows.sparkSession
    if not publish.exists(spark, table):
        publish.create(spark, table, publish.optional(rows.schema))
    by = publish.partition_columns(spark, table)
    wanted = spark.table(table).schema
    rows, needed, nulls = publish.conform(rows, wanted), publish.required_columns(spark, table), None
    if needed and relax:
        nulls = Observation(f"nulls_{uuid.uuid4().hex}")
        rows = rows.observe(nulls, *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in needed])
    rows = publish.within(rows if relax else publish.required(rows, needed), only)
    folder = staging_folder(spark, table)
    (rows.write.partitionBy(*by) if by else rows.write).parquet(folder)
    moves = Files(spark).data(folder)
    named: set[tuple[str, ...]] = set()
    if touched is not None:
        named = {tuple(f"{c}={publish.folder_name(r[c])}" for c in by) for r in (touched.select(*by).distinct() if by else touched.limit(1)).collect()}
    relaxes = [c for c in needed if nulls.get[c]] if nulls is not None else []
    return Change(table, folder, moves, _removed(spark, table, moves, mode, named), f"{uuid.uuid4().hex[:12]}-", relaxes)


def stage_split(rows: DataFrame, mappings: list[tuple[str, str]], append: bool = True, template: str | None = None, relax: bool = False) -> list[Change]:
    """Write the rows that meet each predicate for its table, all in one pass.

    Where a table has no partitions and takes the rows' types as they are, the files written are
    the ones it gets; other tables' rows are written again as they have them.
    """
    spark, first = rows.sparkSession, mappings[0][1]
    for _, table in mappings:
        if template:
            publish.ensure(spark, table, template)
        elif not publish.exists(spark, table):
            publish.create(spark, table, publish.optional(rows.schema))
    folder = staging_folder(spark, first)
    parts = publish.split(rows, [(when, str(k)) for k, (when, _) in enumerate(mappings)]).withColumnRenamed("dest", "silt_dest")
    parts.write.partitionBy("silt_dest").parquet(folder)
    out, written, mode = [], Files(spark).data(folder), APPEND if append else OVERWRITE
    for k, (_, table) in enumerate(mappings):
        own, wanted = f"silt_dest={k}", {f.name.lower(): f for f in spark.table(table).schema}
        plain = not publish.partition_columns(spark, table) and not publish.required_columns(spark, table)
        if plain and all(f.name.lower() in wanted and wanted[f.name.lower()].dataType == f.dataType for f in rows.schema):
            moves = [w.removeprefix(f"{own}/") for w in written if w.startswith(f"{own}/")]
            out.append(Change(table, f"{folder}/{own}", moves, _removed(spark, table, moves, mode), f"{uuid.uuid4().hex[:12]}-"))
        else:
            mine = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("silt_dest", T.StringType())])).parquet(folder).where(F.col("silt_dest") == str(k)).drop("silt_dest")
            out.append(stage(mine, table, mode, relax=relax))
    return out


def apply(spark: SparkSession, change: Change) -> None:
    """Move a change's files to their table and remove those that go; what has been done is left."""
    files, base = Files(spark), location(spark, change.table)
    if change.relaxes:
        publish.relax(spark, change.table, change.relaxes)

    def moved(name: str) -> None:
        at, _, last = name.rpartition("/")
        files.move(f"{change.staged}/{name}", f"{base}/{at + '/' if at else ''}{change.mark}{last}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(moved, change.moves))
        list(pool.map(lambda name: files.delete(f"{base}/{name}"), change.removes))
    if publish.partition_columns(spark, change.table):
        new = {_partition(m) for m in change.moves}
        for p in sorted(new):
            spark.sql(f"ALTER TABLE {change.table} ADD IF NOT EXISTS PARTITION ({_spec(p)})")
        left = {_partition(f) for f in files.data(base)} if change.removes else set()
        for p in sorted({_partition(r) for r in change.removes} - new - left):
            spark.sql(f"ALTER TABLE {change.table} DROP IF EXISTS PARTITION ({_spec(p)})")
    files.delete(change.staged)
    spark.catalog.refreshTable(change.table)


def _spec(partition: tuple[str, ...]) -> str:
    pairs = (p.partition("=") for p in partition)
    text = lambda v: "null" if v == "__HIVE_DEFAULT_PARTITION__" else "'" + unquote(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"`{k}` = {text(v)}" for k, _, v in pairs)


class Commits:
    """Records of changes, by event, in a folder. Without a folder changes are made at once and not recorded."""

    def __init__(self, spark: SparkSession, folder: str | None):
        self.spark, self.folder, self.files = spark, folder, Files(spark)

    def _at(self, event: str) -> str:
        return f"{self.folder}/{os.path.basename(event)}.json"

    def find(self, event: str) -> dict | None:
        text = self.files.read(self._at(event)) if self.folder else None
        return json.loads(text) if text else None

    def publish(self, event: str, changes: list[Change], outcome: dict | None = None) -> None:
        """Record the changes of an event, then make them. A second record of an event is an error."""
        record = {"event": event, "changes": [asdict(c) for c in changes], "outcome": outcome or {}}
        if self.folder and not self.files.create(self._at(event), json.dumps(record)):
            raise FileExistsError(f"{event} has been published")
        self.finish(record)

    def finish(self, record: dict) -> None:
        """Make what is left of a recorded change."""
        for c in record["changes"]:
            apply(self.spark, Change(**c))

    def forget(self, event: str) -> None:
        if self.folder:
            self.files.delete(self._at(event))
