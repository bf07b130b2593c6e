"""The corpus pipeline: quality, line dedup, near-duplicates, mixing, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import common, lines, minhash, mixing, pieces, quality


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines similar to an earlier line; those of nothing else are dropped."""
    return lines.drop_repeated_lines(docs, keep_emptied=False)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest id, of each group of near-duplicates at similarity 0.8."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to twice, or not at all."""
    return mixing.mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentations of each document of the mix."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("source_mixing", mix_sources),
    ("piece_encoding", encode_pieces),
]

#: The classifier and the rounding are outside SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    folder, read = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if read:
            common.discard(spark, read)  # its only reader has written what it made of it
        docs, read = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
