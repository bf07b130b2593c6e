"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share.

    It is the one named by spark.checkpoint.dir; only a local session without one (tests,
    notebooks) gets a folder of its own, as executors elsewhere could not read it.
    """
    set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltworks-checkpoint-"))
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
    return set_.get()


#: Shuffle files of a written step are of no more use; Spark then deletes them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    old = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, old)


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder, cut its lineage, free its shuffle files."""
    shared_folder(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        # a new query: the setting is read when one is made
        return df.select("*").checkpoint(eager=True)


def written(df: DataFrame, options: dict | None = None) -> DataFrame:
    """As `cut`, but as a compressed table: for large rows. The table stays in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.select("*").write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that has no reader any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def word_count(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ordered_prefix(df: DataFrame, order: list[str], value: str) -> tuple[DataFrame, int]:
    """The rows with `before` (sum of `value` over all rows that sort before) and `row` (their number).

    The rows are dealt to ranges of the sort order and written there; only one total for each
    range is gathered, and each range then adds up its own rows behind the total of the ranges
    before it. The totals are as many as there are partitions. Rows that are equal in `order`
    get distinct, adjacent places. Also returns the sum over all rows.
    """
    parts = n_partitions(df.sparkSession)
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_tie")
    ranged = cut(ranged.withColumn("_part", F.spark_partition_id()))
    totals = (
        ranged.groupBy("_part").agg(F.sum(value).cast("long").alias("total"), F.count("*").alias("rows")).orderBy("_part").collect()
    )
    offsets, total, rows = [], 0, 0
    for t in totals:
        offsets.append((t["_part"], total, rows))
        total, rows = total + t["total"], rows + t["rows"]
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _before long, _rows long")
    w = Window.partitionBy("_part").orderBy(*order, "_tie")
    placed = (
        ranged.join(F.broadcast(starts), "_part")
        .withColumn("row", F.col("_rows") + F.row_number().over(w) - 1)
        .withColumn("before", F.col("_before") + F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
        .drop("_part", "_tie", "_before", "_rows")
    )
    return placed, total


def block_cells(members: DataFrame, keys: list[str], spread: Column, block_rows: int, weight: str | None = None, block_weight: int = 1) -> DataFrame:
    """Split every group into blocks and place each row in every pair of blocks it belongs to.

    Groups of one row go. A group of up to `block_rows` rows is one cell (0, 0). A larger one
    is split by `spread` into blocks of about that many rows, and its rows are repeated so that
    each pair of blocks (lo, hi) meets in exactly one cell; no group is capped, and no cell
    holds more than about two blocks. With a column of weights, blocks are also of about
    `block_weight` at most, or of single rows. Adds lo, hi and blk.
    """
    heavy = F.sum(weight) if weight else F.lit(0)
    sizes = members.groupBy(*keys).agg(F.count("*").alias("_n"), heavy.alias("_w")).where("_n > 1")
    blocks = F.greatest(F.ceil(F.col("_n") / block_rows), F.least(F.col("_n"), F.ceil(F.col("_w") / block_weight))).cast("int")
    return (
        members.join(sizes, keys)
        .withColumn("_blocks", blocks)
        .withColumn("blk", F.pmod(spread, F.col("_blocks")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("lo", F.least("blk", "_with"))
        .withColumn("hi", F.greatest("blk", "_with"))
        .drop("_n", "_w", "_blocks", "_with")
    )


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int = 20_000) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Chunks of a stream sorted by `keys` that never break a group, with each group's start.

    Yields (chunk, starts), where starts also has the chunk's length as its last entry.
    """

    def chunk(parts):
        frame = pd.concat(parts, ignore_index=True)
        new = np.zeros(len(frame), bool)
        new[:1] = True
        for k in keys:
            v = frame[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return frame, np.flatnonzero(new)

    held, n = [], 0
    for batch in batches:
        if len(batch) == 0:
            continue
        held.append(batch)
        n += len(batch)
        if n >= rows:
            frame, starts = chunk(held)
            last = int(starts[-1])
            if last:
                yield frame.iloc[:last].reset_index(drop=True), starts
            held, n = [frame.iloc[last:]], len(frame) - last
    if n:
        frame, starts = chunk(held)
        yield frame, np.append(starts, len(frame))


def group_pairs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each group, as index arrays, one distance at a time."""
    ends = np.repeat(starts[1:], np.diff(starts))
    left = np.arange(len(ends))
    d = 1
    while len(left := left[left + d < ends[left]]):
        yield left, left + d
        d += 1


def smallest_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that the links i - j reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root being the smallest node reachable.

    Alternates the large-star and small-star steps, which keep the number of links and turn
    every component into a star around its smallest node. Each step is an aggregate and a join
    on the node, and its links are written before the next; none reach the driver, only a
    count and a checksum that tell when nothing changes.
    """
    links = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b")
        links = cut(
            small.select(F.col("m").alias("a"), "b").union(small.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
        )
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select("a", "a").distinct())
