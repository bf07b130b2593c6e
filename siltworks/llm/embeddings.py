"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

Every table hashes a vector to the signs of its products with a few random hyperplanes. Two
vectors at angle a agree on one sign with probability 1 - a / pi, so with `bits` signs a pair
right at the threshold meets in one of `tables` tables with probability
1 - (1 - (1 - a / pi) ** bits) ** tables. Bits grow with the logarithm of the number of rows,
to hold buckets small, and tables are as many as make that probability RECALL or more.

Equal vectors are one class first, and the bucket numbers of a class in all tables are computed
once and go with it. Within buckets, exact cosines are taken in double precision, of vectors kept
in the numbers that they came in; a pair that already met in an earlier table is left out, so links
are counted once and no list of pairs is ever shuffled: a bucket gives link counts of its rows and
stars of what is linked. Buckets beyond BLOCK rows are split into pairs of blocks, none is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.common import block_cells, components, cut, group_pairs, n_partitions, smallest_labels, table, whole_groups

RECALL = 0.998
PER_BUCKET = 8
BLOCK = 1_000


def plan(rows: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for so many distinct vectors."""
    same = 1 - math.acos(threshold) / math.pi
    bits = max(8, math.ceil(math.log2(max(1, rows / PER_BUCKET))))
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same**bits))


def hyperplanes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([dim, bits, tables, 7]).standard_normal((dim, bits * tables))


def keys_of(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) bucket numbers."""
    signs = (vectors @ hyperplanes(vectors.shape[1], bits, tables)) >= 0
    return signs.reshape(len(vectors), tables, bits) @ (np.int64(1) << np.arange(bits))


def _packed(batches: Iterator[pd.DataFrame], number: str) -> Iterator[pd.DataFrame]:
    """Vectors as bytes of floats or doubles; null where the vector links with nothing."""

    def one(v):
        if v is None:
            return None
        x = np.array([np.nan if y is None else y for y in v], number)
        return x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None

    for batch in batches:
        yield pd.DataFrame({"vec_id": batch.vec_id, "vec": [one(v) for v in batch.embedding]})


def _stack(packed: pd.Series, number: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed), number).reshape(len(packed), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _keyed(batches: Iterator[pd.DataFrame], number: str, bits: int, tables: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, rows in batch.groupby(batch.vec.map(len), sort=True):
            keys = keys_of(_unit(_stack(rows.vec, number)), bits, tables)
            yield rows.assign(dim=len(rows.vec.iloc[0]) // np.dtype(number).itemsize, keys=list(keys))


def _linked(batches: Iterator[pd.DataFrame], threshold: float, number: str) -> Iterator[pd.DataFrame]:
    """For each class of each bucket: how many vectors it links with there, and its star."""
    for rows, starts in whole_groups(batches, ["dim", "tab", "bucket", "lo", "hi"], 10_000):
        n = len(rows)
        dims, tab, cls, weight = rows.dim.to_numpy(), rows.tab.to_numpy(), rows.cls.to_numpy(), rows.weight.to_numpy()
        keys = np.stack(rows["keys"].to_numpy())
        across, blk = (rows.lo != rows.hi).to_numpy(), rows.blk.to_numpy()
        links, found = np.zeros(n, np.int64), []
        for dim in np.unique(dims):  # the stream is sorted by dim
            first, last = np.searchsorted(dims, [dim, dim + 1])
            unit = _unit(_stack(rows.vec.iloc[first:last], number))
            inside = starts[(starts >= first) & (starts <= last)] - first
            for i, j in group_pairs(inside):
                meet = ~across[i + first] | (blk[i + first] != blk[j + first])
                i, j = i[meet], j[meet]
                for part in range(0, len(i), 100_000):
                    a, b = i[part : part + 100_000], j[part : part + 100_000]
                    near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                    a, b = a[near] + first, b[near] + first
                    new = (keys[a] == keys[b]).argmax(axis=1) == tab[a]
                    found.append((a[new], b[new]))
        left = np.concatenate([a for a, _ in found] or [np.zeros(0, int)])
        right = np.concatenate([b for _, b in found] or [np.zeros(0, int)])
        np.add.at(links, left, weight[right])
        np.add.at(links, right, weight[left])
        label = smallest_labels(n, left, right)
        some = np.flatnonzero(links)
        yield pd.DataFrame({"a": cls[some], "b": cls[label[some]], "links": links[some]})


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Rows whose cosine is at least `threshold` in double precision are linked; component_id is
    the smallest id that links reach. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, nor do vectors of different lengths. Equal
    vectors link with each other, repeated rows count as rows of their own, and an empty table
    gives no rows. Different vectors under one id are rows of their own too, each linked by its
    own cosines. Ids are taken to be present: a null id keeps a null component.
    """
    spark = vectors.sparkSession
    parts = n_partitions(spark)
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    number = "<f4" if plain.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    packed = cut(plain.mapInPandas(lambda it: _packed(it, number), "vec_id long, vec binary").withColumn("same", F.sha1("vec")))
    usable = packed.where("vec is not null and vec_id is not null")
    # a class has a number of its own: different vectors may have the same smallest id
    grouped = usable.groupBy("same").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    classes = cut(grouped.withColumn("cls", F.monotonically_increasing_id()))
    bits, tables = plan(classes.count(), threshold)

    shape = "cls long, weight long, vec binary, dim int, keys array<long>"
    keyed = cut(classes.select("cls", "weight", "vec").mapInPandas(lambda it: _keyed(it, number, bits, tables), shape))
    buckets = keyed.select("cls", "dim", F.posexplode("keys").alias("tab", "bucket"))
    cells = block_cells(buckets, ["dim", "tab", "bucket"], F.xxhash64("cls"), BLOCK).join(keyed.drop("dim"), "cls")
    order = ["dim", "tab", "bucket", "lo", "hi"]
    stars = cut(
        cells.select(*order, "blk", "cls", "weight", "vec", "keys")
        .repartition(parts, *order)
        .sortWithinPartitions(*order, "cls")
        .mapInPandas(lambda it: _linked(it, threshold, number), "a long, b long, links long")
    )
    counts = stars.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "cls")
    found = cut(components(stars.select("a", "b")).select(F.col("node").alias("cls"), "root").join(classes.select("cls", "least"), "cls"))
    smallest = found.groupBy("root").agg(F.min("least").alias("smallest"))
    found = found.join(smallest, "root").select("cls", "smallest")
    classed = (
        classes.select("same", "cls", "weight", "least")
        .join(counts, "cls", "left")
        .join(found, "cls", "left")
        .select("same", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("smallest", "least").alias("component_id"))
    )
    linked = usable.select("vec_id", "same").join(classed, "same").select("vec_id", "n_links", "component_id")
    alone = packed.where("vec is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
