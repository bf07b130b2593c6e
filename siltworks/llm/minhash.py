"""MinHash near-duplicates by an inverted join on signature coordinates.

1. Every text becomes its set of word shingles (64-bit hashes) and K minimum hashes of the set.
   Equal sets are one class, whatever their number, so exact copies never meet in a join.
2. A class is posted under (coordinate, value) for a prefix of the coordinates. Two signatures
   that agree on at least `least` of K coordinates must agree within the first K - least + 1,
   so the prefix loses none of them. In each posting list the agreeing coordinates of two
   signatures are counted; a pair that already met in an earlier list is skipped. The least
   count lies 4.75 standard deviations below that of a pair right at the threshold.
3. Lists give links between candidates as stars, not pairs. Within each group of candidates
   links are confirmed on the full shingle sets, read again from the texts, and connected
   components of what holds are the duplicates.

Lists and groups beyond BLOCK rows, or of texts with more than BLOCK_SHINGLES shingles, are split
into blocks, and each pair of blocks is a task of its own (`common.block_cells`): nothing is capped
and no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import block_cells, components, cut, group_pairs, n_partitions, smallest_labels, table, whole_groups, written

K = 64
BLOCK = 1_000
BLOCK_SHINGLES = 2_000_000
SHINGLE = 5

_U = np.uint64
_RNG = np.random.default_rng(20_240_229)
_MULTIPLY = _RNG.integers(1, 2**63, K, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _RNG.integers(0, 2**63, K, dtype=np.uint64)


class _Words(dict):
    """64-bit hashes of words, kept while a task runs; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, known: _Words, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z in lower case.

    A text of fewer words is one shingle, and one without words has none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter((known[w] for w in words), np.uint64, len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(shingles), 4_096):
        low = np.minimum(low, (shingles[part : part + 4_096, None] * _MULTIPLY + _ADD).min(axis=0))
    return (low >> _U(32)).astype(">u4")


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _signed(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    known = _Words()
    for batch in batches:
        sets = [shingle_set(t, known, n) for t in batch.text]
        yield pd.DataFrame(
            {
                "doc_id": batch.doc_id,
                "n_shingles": [len(s) for s in sets],
                "cls": [set_key(s) for s in sets],
                "sig": [signature(s).tobytes() if len(s) else None for s in sets],
            }
        )


def least_matches(threshold: float) -> int:
    return max(1, math.floor(K * threshold - 4.75 * math.sqrt(K * threshold * (1 - threshold))))


def _collisions(batches: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Stars (a, b) of classes in each posting list whose signatures agree often enough."""
    for rows, starts in whole_groups(batches, ["key", "lo", "hi"]):
        # 16 of each coordinate's 32 bits suffice for counting, not for the first common one
        whole = np.frombuffer(b"".join(rows.sig), ">u4").reshape(len(rows), K)
        sig, place = whole.astype(np.uint16), rows.place.to_numpy()
        across, blk = (rows.lo != rows.hi).to_numpy(), rows.blk.to_numpy()
        left, right = [], []
        for i, j in group_pairs(starts):
            if across.any():
                meet = ~across[i] | (blk[i] != blk[j])
                i, j = i[meet], j[meet]
            for part in range(0, len(i), 50_000):
                a, b = i[part : part + 50_000], j[part : part + 50_000]
                often = (sig[a] == sig[b]).sum(axis=1) >= least
                a, b = a[often], b[often]
                # at its first common coordinate a pair is counted; in later lists it is skipped
                keep = (whole[a] == whole[b]).argmax(axis=1) == place[a]
                left.append(a[keep])
                right.append(b[keep])
        label = smallest_labels(len(rows), np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)]))
        own = np.flatnonzero(label != np.arange(len(rows)))
        cls = rows.cls.to_numpy()
        yield pd.DataFrame({"a": cls[own], "b": cls[label[own]]})


def _confirmed(batches: Iterator[pd.DataFrame], threshold: int, n: int) -> Iterator[pd.DataFrame]:
    """Links of classes within each group of candidates that hold on their full sets."""
    known = _Words()
    for rows, starts in whole_groups(batches, ["grp", "lo", "hi"], 2_000):
        left, right = [], []
        across, blk, cls, text = (rows.lo != rows.hi).to_numpy(), rows.blk.to_numpy(), rows.cls.to_numpy(), rows.text.to_numpy()
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            sets = [shingle_set(t, known, n) for t in text[s:e]]
            # a row whose id belongs to several texts also comes with the others; those go
            mine = [set_key(x) == c for x, c in zip(sets, cls[s:e], strict=True)]
            size = np.array([len(x) for x in sets])
            flat, where = np.unique(np.concatenate(sets), return_inverse=True)
            offset = np.concatenate([[0], np.cumsum(size)])
            owner = np.repeat(np.arange(e - s), size)
            label, marked = np.arange(e - s), np.zeros(len(flat), bool)
            for r in range(e - s - 1):
                rest = (label != label[r]) & (np.arange(e - s) > r)
                if across[s]:
                    rest &= blk[s:e] != blk[s + r]
                if not mine[r] or not rest.any():
                    continue
                marked[where[offset[r] : offset[r + 1]]] = True
                common = np.bincount(owner, weights=marked[where], minlength=e - s).astype(np.int64)
                marked[:] = False
                hits = np.flatnonzero(rest & np.array(mine) & (100 * common >= threshold * (size + size[r] - common)))
                for h in hits.tolist():
                    left.append(s + r)
                    right.append(s + h)
                if len(hits):
                    label[np.isin(label, label[hits])] = label[r]
        yield pd.DataFrame({"a": cls[np.array(left, int)], "b": cls[np.array(right, int)]})


def near_duplicates(docs: DataFrame, threshold: int = 85, n: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; threshold in hundredths.

    Rows whose sets have 100 * intersection >= threshold * union are linked, and component_id
    is the smallest id that links reach. Null texts and texts without words link with nothing
    and keep their own id. Equal ids and repeated rows stay separate rows with one component;
    a null id is never the smallest unless a component has no other, and then kept is true.
    """
    spark = docs.sparkSession
    parts = n_partitions(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = cut(texts.mapInPandas(lambda it: _signed(it, n), "doc_id long, n_shingles long, cls binary, sig binary"))
    classes = signed.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("weight"))
    classes = cut(classes)

    least = least_matches(threshold / 100)
    value = lambda c: F.xxhash64(F.lit(c), F.substring("sig", 4 * c + 1, 4))
    posted = classes.select("cls", F.posexplode(F.array(*[value(c) for c in range(K - least + 1)])).alias("place", "key"))
    listed = block_cells(posted, ["key"], F.xxhash64("cls"), BLOCK).join(classes.select("cls", "sig"), "cls")
    stars = (
        listed.select("key", "lo", "hi", "blk", "place", "cls", "sig")
        .repartition(parts, "key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "cls")
        .mapInPandas(lambda it: _collisions(it, least), "a binary, b binary")
    )
    candidates = components(stars)

    members = candidates.join(classes.select("cls", "rep", "weight"), candidates["node"] == classes["cls"]).select("cls", F.col("root").alias("grp"), "rep", "weight")
    cells = cut(block_cells(members, ["grp"], F.xxhash64("cls"), BLOCK, "weight", BLOCK_SHINGLES))
    links = (
        cells.join(texts, cells["rep"].eqNullSafe(texts["doc_id"]))
        .select("grp", "lo", "hi", "blk", "cls", "text")
        .repartition(parts, "grp", "lo", "hi")
        .sortWithinPartitions("grp", "lo", "hi", "cls")
        .mapInPandas(lambda it: _confirmed(it, threshold, n), "a binary, b binary")
    )
    found = components(links)
    reps = found.join(classes.select("cls", "rep"), found["node"] == classes["cls"])
    smallest = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = reps.join(smallest, "root").select("cls", "component_id")
    every = classes.select("cls", "rep").join(linked, "cls", "left").select("cls", F.coalesce("component_id", "rep").alias("component_id"))
    joined = signed.select("doc_id", "n_shingles", "cls").join(every, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each group one row of its smallest id stays.

    Rows are judged as rows, whatever ids they share: of several with the smallest id the first
    by text stays, and a null id comes after all others. Texts without words all stay, and an
    empty table gives no rows.
    """
    keyed = written(docs.select(F.struct(*docs.columns).alias("_row"), F.monotonically_increasing_id().alias("_key")))
    texts = keyed.select("_key", F.col(f"_row.`{text_col}`").alias("text"))
    found = near_duplicates(texts, threshold, SHINGLE, "_key", "text").where("n_shingles > 0").select(F.col("doc_id").alias("_key"), "component_id")
    own = keyed.select("_key", F.col(f"_row.`{id_col}`").cast("long").alias("id"), F.sha1(F.col(f"_row.`{text_col}`")).alias("text"))
    first = F.struct(F.col("id").isNull(), "id", "text", "_key")
    stay = found.join(own, "_key").groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first._key").alias("_key"))
    gone = found.select("_key").join(stay, "_key", "left_anti")
    return keyed.join(gone, "_key", "left_anti").select("_row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
