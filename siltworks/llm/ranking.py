"""Ranked lexical search over a bit-sliced impact index.

The impact of a term in a document is an integer below 2^20. The index holds documents in blocks;
for each block and term there is one row with the places of the documents that have the term, and
the bits of their impacts in slices: first all lowest bits, then all second ones, and so on.

A query spreads a term's slices over the block, as bitmaps with a bit for each document, and
multiplies them by the term's weight: one shifted copy for each set bit of the weight. Copies
and terms are added by carry-save adders on whole bitmaps, three numbers to two at a time, and the
last two by rippling the carry. The best k are then found from the highest slice down: documents
with the bit set are in if no more than k are, and else alone stay in question.

Blocks are even in documents and built where their documents are read, so that building takes
no shuffle. Items come in chunks. A chunk's terms meet the index's rows by term, which sends to
each (chunk, block) just the slices that are asked for; each gives k documents an item at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import cut, table, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same in UTF-8.
TERM_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Documents of a block at most, and bytes of text beyond which no more are taken in.
BLOCK = 1 << 13
BLOCK_BYTES = 1 << 25
BITS = 20
#: Items of a chunk on average.
ITEMS = 256
#: Terms of items and their lists of rows are looked up by broadcast up to so many bytes, else by a shuffle.
LOOKED_UP = 1 << 25
#: Bytes of weighted slices that a task keeps for its next items.
KEPT = 1 << 26

INDEX = "block long, term string, n int, places binary, slices binary, ids binary, known binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("term", pa.string()), ("n", pa.int32()), ("places", pa.binary()), ("slices", pa.binary()), ("ids", pa.binary()), ("known", pa.binary())])


def terms_of(text: Column) -> Column:
    """All terms of a text, with repeats."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def collection(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """How many documents have a term, and how many terms all have."""
    n = F.coalesce(F.regexp_count(F.col(text_col), F.lit(TERM)), F.lit(0)).cast("long")
    r = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return r["docs"], r["terms"]


def sliced(impacts: np.ndarray) -> np.ndarray:
    """Bits of each row's impacts, slice by slice from the lowest, as bytes."""
    bits = (impacts[:, None, :] >> np.arange(BITS, dtype=np.int64)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(impacts), -1), axis=1, bitorder="little")


def _fixed_width(rows: np.ndarray) -> pa.Array:
    """Rows of bytes, all of one length, as an array of binaries."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def block_rows(block: int, ids: list, texts: list[bytes], n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    """A block's rows: one with the documents' ids, and one for each term."""
    known = np.array([i is not None for i in ids], bool)
    packed_ids = np.array([i if i is not None else 0 for i in ids], "<i8").tobytes()
    yield pa.record_batch([[block], [None], [len(ids)], [None], [None], [packed_ids], [np.packbits(known, bitorder="little").tobytes()]], schema=_SCHEMA)
    number, found, lengths = {}, [], []
    for text in texts:
        terms = TERM_BYTES.findall(text.lower())  # of bytes, only A-Z are lowered
        lengths.append(len(terms))
        found.append(np.fromiter([number.setdefault(t, len(number)) for t in terms], np.int64, len(terms)))
    if not number:
        return
    key = np.concatenate(found) * len(texts) + np.repeat(np.arange(len(texts)), lengths)
    key, tf = np.unique(key, return_counts=True)
    of, place = np.divmod(key, len(texts))
    slow = np.array([10 + 90 * n * n_docs // n_terms for n in lengths], np.int64)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * slow[place])
    place = place.astype("<u2")
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    sizes = np.diff(np.append(starts, len(of)))
    order = np.argsort(sizes, kind="stable")
    names = pa.array(number, pa.binary()).cast(pa.string()).take(pa.array(order))
    places, slices, at = [], [], 0
    while at < len(order):
        n = int(sizes[order[at]])
        end = min(int(np.searchsorted(sizes[order], n, "right")), at + max(1, (1 << 19) // n))
        rows = starts[order[at:end]][:, None] + np.arange(n)
        places.append(_fixed_width(place[rows].view(np.uint8)))
        slices.append(_fixed_width(sliced(impact[rows])))
        at = end
    nulls = pa.nulls(len(order), pa.binary())
    numbers = [pa.array(np.full(len(order), block)), names, pa.array(sizes[order].astype(np.int32))]
    whole = pa.record_batch([*numbers, pa.concat_arrays(places), pa.concat_arrays(slices), nulls, nulls], schema=_SCHEMA)
    for at in range(0, len(whole), 1 << 15):
        yield whole.slice(at, 1 << 15)


def build_index(docs: DataFrame, n_docs: int, n_terms: int, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The index of all documents and all their terms, written to the shared folder.

    Ids are longs. Each row of docs is a document, equal ids and rows too; null and empty texts
    have no terms. Of a block's row of ids, places are the documents' order in it.
    """
    if not 0 < block <= 1 << 16:
        raise ValueError("places in a block have two bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, texts, size = TaskContext.get().partitionId() << 33, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                size += len(texts[-1])
                if len(ids) >= block or size >= BLOCK_BYTES:
                    yield from block_rows(at, ids, texts, n_docs, n_terms)
                    at, ids, texts, size = at + 1, [], [], 0
        if ids:
            yield from block_rows(at, ids, texts, n_docs, n_terms)

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return written(plain.mapInArrow(run, INDEX))


def add(numbers: list[np.ndarray], slices: int) -> np.ndarray:
    """The sum of numbers that are given as rows of bitmaps, from the lowest bit."""
    width = numbers[0].shape[1]

    def wide(x: np.ndarray) -> np.ndarray:
        if len(x) == slices:
            return x
        out = np.zeros((slices, width), np.uint64)
        out[: len(x)] = x
        return out

    left = [wide(x) for x in numbers]
    while len(left) > 2:
        # rounds, so that carries stay as short as they can
        three, left = [left[i : i + 3] for i in range(0, len(left) - len(left) % 3, 3)], left[len(left) - len(left) % 3 :]
        for a, b, c in three:
            either = a ^ b
            carry = np.zeros_like(a)
            carry[1:] = ((a & b) | (either & c))[:-1]
            left += [either ^ c, carry]
    if len(left) == 1:
        return left[0]
    a, b = left
    out, both = a ^ b, a & b
    carry = both[0].copy()
    for i in range(1, slices):
        out[i], carry = out[i] ^ carry, both[i] | (out[i] & carry)
    return out


def spread(places: bytes, slices: bytes, n: int, width: int) -> np.ndarray:
    """A term's impacts as bitmaps over the block, from the lowest bit; width is in words of 64."""
    bits = np.unpackbits(np.frombuffer(slices, np.uint8), count=BITS * n, bitorder="little").reshape(BITS, n)
    whole = np.zeros((BITS, width * 64), np.uint8)
    whole[:, np.frombuffer(places, "<u2")] = bits
    return np.packbits(whole, axis=1, bitorder="little").view(np.uint64)


def times(number: np.ndarray, weight: int) -> np.ndarray:
    """A number of bitmaps times a positive integer."""
    slices = len(number) + weight.bit_length()
    copies = []
    for shift in range(weight.bit_length()):
        if weight >> shift & 1:
            copies.append(np.zeros((slices, number.shape[1]), np.uint64))
            copies[-1][shift : shift + len(number)] = number
    return add(copies, slices)


def best(number: np.ndarray, k: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the k largest values above 0, of equal ones those of smaller order."""
    count = lambda x: int(np.bitwise_count(x).sum())
    inside, asked, taken = np.zeros(number.shape[1], np.uint64), np.bitwise_or.reduce(number, axis=0), 0
    for i in range(len(number) - 1, -1, -1):
        with_bit = asked & number[i]
        n = count(with_bit)
        if taken + n > k:
            asked = with_bit
            continue
        inside |= with_bit
        taken += n
        asked &= ~number[i]
        if taken == k:
            asked[:] = 0
            break
    at = lambda x: np.flatnonzero(np.unpackbits(x.view(np.uint8), bitorder="little"))
    tied = at(asked)
    if len(tied) > k - taken:
        tied = tied[np.argsort(order[tied], kind="stable")[: k - taken]]
    places = np.concatenate([at(inside), tied])
    bits = np.unpackbits(np.ascontiguousarray(number[:, places // 64]).view(np.uint8).reshape(len(number), -1, 8), axis=2, bitorder="little")
    bits = bits[:, np.arange(len(places)), places % 64].astype(np.int64)
    return places, (bits << np.arange(len(number))[:, None]).sum(axis=0)


RESULT = "row long, doc_id long, score long"


def _search_block(group: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best documents of one block for each item of one chunk."""
    heads = group.ids.notna()
    head, terms = group[heads].iloc[0], group[~heads]
    ids = np.frombuffer(head.ids, "<i8")
    known = np.unpackbits(np.frombuffer(head.known, np.uint8), count=len(ids), bitorder="little").astype(bool)
    width = -(-len(ids) // 64)
    rank = np.full(width * 64, len(ids))
    rank[np.lexsort((ids, ~known))] = np.arange(len(ids))
    of: dict[int, list[int]] = {}
    for t, rows in enumerate(terms["rows"]):
        for r in rows:
            of.setdefault(int(r), []).append(t)
    places, slices, n, weight = (terms[c].tolist() for c in ("places", "slices", "n", "weight"))
    kept: dict[int, np.ndarray] = {}
    room, out = max(1, KEPT // (8 * width * (BITS + 16))), []

    def weighted(t: int) -> np.ndarray:
        if t not in kept:
            if len(kept) >= room:
                kept.clear()
            kept[t] = times(spread(places[t], slices[t], n[t], width), weight[t])
        return kept[t]

    for row, asked in of.items():
        numbers = [weighted(t) for t in asked]
        at, score = best(add(numbers, max(map(len, numbers)) + len(numbers).bit_length()), k, rank)
        out.append(pd.DataFrame({"row": row, "doc_id": pd.arrays.IntegerArray(ids[at].copy(), ~known[at]), "score": score}))
    return pd.concat(out) if out else pd.DataFrame({"row": [], "doc_id": [], "score": []}, dtype="int64")


def search(index: DataFrame, n_docs: int, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", out_col: str = "doc_id") -> DataFrame:
    """(id, rank, out, score): the k highest-scoring documents of the index for each row of items.

    All are given that score above 0, if fewer. Equal scores are in order of document ids, null
    last. Each row of items is asked by itself, so an id that is there twice has two lists; a
    null or empty text, or terms that no document has, give nothing.
    """
    rows = cut(items.select(F.col(id_col).alias("_item"), F.array_distinct(terms_of(F.col(text_col))).alias("terms")).withColumn("row", F.monotonically_increasing_id()))
    chunks = max(1, -(-rows.count() // ITEMS))
    each = rows.select("row", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk"), F.explode("terms").alias("term"))
    asked = cut(each.groupBy("chunk", "term").agg(F.collect_list("row").alias("rows")))
    held = asked.agg(F.coalesce(F.sum(F.octet_length("term") + 8 * F.size("rows") + 64), F.lit(0))).first()[0]
    small = F.broadcast if held <= LOOKED_UP else lambda df: df
    posted = index.where("term is not null")
    found = posted.select("term", "n").join(small(asked.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighted = asked.join(found.select("term", weight.alias("weight")).where("weight > 0"), "term")
    hits = posted.drop("ids", "known").join(small(weighted), "term").select("chunk", "block", "weight", "rows", "n", "places", "slices", F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("known"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    heads = index.where("term is null").select(
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "block", F.lit(0).cast("long").alias("weight"), none("array<long>", "rows"), "n", none("binary", "places"), none("binary", "slices"), "ids", "known"
    )
    scored = hits.union(heads).groupBy("chunk", "block").applyInPandas(lambda group: _search_block(group, k), RESULT)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(rows.select("row", "_item"), "row").select(F.col("_item").alias(id_col), "rank", F.col("doc_id").alias(out_col), "score")


def op12(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_docs, n_terms = collection(docs)
    return search(build_index(docs, n_docs, n_terms), n_docs, table(spark, sf_dir, "benchmark"))
