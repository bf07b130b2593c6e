"""Contiguous, byte-balanced shards from global prefix sums of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import ordered_prefix


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place every row in one of `shards` contiguous ranges of ids of near-equal bytes.

    A row's size is the UTF-8 length of its text plus 1. Rows sort by id (null first), then
    size, checksum and their place in the input. Sizes are summed in that order, from a total
    for each partition, and the row whose middle byte falls in the k-th equal part of all bytes goes
    to shard k, so no shard is off its target by more than one row's size. Returns id, size, text_crc32, shard, slot (place in its
    shard, from 0) and the byte offset `before`. Null texts count no bytes and have a null
    checksum, equal ids and repeated rows keep a place each, an empty table gives no rows, and
    a document longer than a target fills shards on its own, leaving some empty.
    """
    rows = docs.select(
        F.col(id_col),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
    )
    placed, whole = ordered_prefix(rows, [id_col, "size", "text_crc32"], "size")
    placed = placed.withColumn("shard", F.expr(f"cast((2 * before + size) * {shards} div {max(1, 2 * whole)} as int)"))
    starts = placed.groupBy("shard").agg(F.min("row").alias("_first"))
    return placed.join(F.broadcast(starts), "shard").withColumn("slot", F.col("row") - F.col("_first")).drop("row", "_first")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_by_bytes(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
