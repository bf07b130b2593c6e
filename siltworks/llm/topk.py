"""Exact top-k inner products by block-at-a-time pruning.

A component is a term and a document holds all terms. Documents are put in order of the signs of
their first components and cut into blocks, so that alike ones lie together. A block keeps, besides
its forward index (the integers of its documents), the greatest and least value of every term.
For a query, the sum over terms of the larger of q * greatest and q * least bounds every score in
the block. Blocks are scored in order of falling bounds until a bound lies below the k-th score.

1. One pass over documents and queries in this order writes the blocks, in runs of RUN, and
   scores each query in the run where it falls itself. Its k-th score there is its floor.
2. Chunks of queries meet the maxima alone, a hundredth of the documents. A query goes on to a
   run only if a bound of one of its blocks reaches the query's floor.
3. Runs meet the queries that go there, in tiles of one run and one chunk, which start at the
   floors. The k best of a query's home and tiles are its answer.

Nothing is broadcast or gathered, and a task holds one run or one chunk at a time. Where bounds
are loose (vectors without neighbours in many dimensions), few runs are left out: the result is
exact all the same, and the work that of a product of all queries with all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import n_partitions, table, written

BLOCK = 256
RUN = 64
CHUNK = 4_096
#: So many first components give the order of documents.
SIGNS = 16
LONG = np.iinfo(np.int64)


def quantised(vector_col: str, scale: int = 256):
    """floor(scale * x) of every component as long; null where a component is null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    ok = F.col(vector_col).isNotNull() & F.forall(vector_col, finite)
    return F.when(ok, F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _most(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def number_type(docs: np.ndarray, query: np.ndarray) -> type:
    """In which numbers every product and sum of these is exact: doubles, longs or Python's."""
    most = _most(docs) * _most(query) * max(1, docs.shape[-1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object


def as_long(x: np.ndarray) -> np.ndarray:
    """Exact sums as longs; those beyond count as the ends of long."""
    return np.array([min(max(int(v), LONG.min), LONG.max) for v in x], np.int64) if x.dtype == object else x.astype(np.int64)


def bounds(query: np.ndarray, top: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The greatest score that a document of each block can have."""
    return as_long(np.maximum(query * top, query * low).sum(axis=1))


def best_of_block_order(query: np.ndarray, own: int, docs: np.ndarray, ids: np.ndarray, top: np.ndarray, low: np.ndarray, k: int, block: int, floor: int = LONG.min):
    """The k best (score, id) for one query and the number of blocks scored; ties to the smaller id.

    What scores below the floor may be left out: the query has k that reach it elsewhere.
    """
    bound = bounds(query, top, low)
    best_s, best_i, least, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), floor, 0
    for b in np.argsort(~bound, kind="stable"):
        if bound[b] < least:
            break
        rows = slice(b * block, (b + 1) * block)
        score, cand = as_long(docs[rows] @ query), ids[rows]
        scored += 1
        keep = (cand != own) & (score >= least)
        if keep.any():
            s, i = np.concatenate([best_s, score[keep]]), np.concatenate([best_i, cand[keep]])
            order = np.lexsort((i, ~s))[:k]
            best_s, best_i = s[order], i[order]
            if len(best_s) == k:
                least = max(least, int(best_s[-1]))
    return best_s, best_i, scored


def _pack(x: np.ndarray) -> tuple[bytes, int]:
    """Integers as bytes of the narrowest width that holds them, and that width."""
    width = next(w for w in (2, 4, 8) if w == 8 or _most(x) < 1 << (8 * w - 1))
    return x.astype(f"<i{width}").tobytes(), width


def _unpack(raw: bytes, width: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").reshape(-1, dim).astype(np.int64)


INDEX = "run long, block long, dim int, ids binary, width int, docs binary, maxima binary, ask long, id long, floor long, best array<struct<vec_id:long,score:long>>"


def _indexed(batches: Iterator[pd.DataFrame], k: int, block: int, run_blocks: int) -> Iterator[pd.DataFrame]:
    """Blocks of a sorted stream, and its queries scored in the run where they stand."""
    place = TaskContext.get().partitionId() << 33
    made = {"run": 0, "ask": 0}
    # no nulls in numbers: they would become doubles on the way to pandas
    nothing = {"run": 0, "block": -1, "dim": 0, "ids": b"", "width": 0, "docs": b"", "maxima": b"", "ask": -1, "id": 0, "floor": LONG.min, "best": []}

    def flush(dim: int, values: list, ids: list, asks: list, ask_ids: list):
        run, out = place + made["run"], []
        made["run"] += 1
        docs, doc_ids = np.concatenate(values) if values else np.zeros((0, dim), np.int64), np.concatenate(ids) if ids else np.zeros(0, np.int64)
        cuts = np.arange(0, len(docs), block)
        top, low = (f.reduceat(docs, cuts) if len(docs) else docs for f in (np.maximum, np.minimum))
        for n, at in enumerate(cuts.tolist()):
            raw, width = _pack(docs[at : at + block])
            maxima = np.concatenate([top[n], low[n]]).astype("<i8").tobytes()
            out.append(nothing | {"run": run, "block": n, "dim": dim, "ids": doc_ids[at : at + block].astype("<i8").tobytes(), "width": width, "docs": raw, "maxima": maxima})
        queries = np.concatenate(asks) if asks else np.zeros((0, dim), np.int64)
        kind = number_type(docs, queries)
        typed = [x.astype(kind) for x in (docs, top, low, queries)]
        for q, whole, own in zip(typed[3], queries, np.concatenate(ask_ids).tolist() if ask_ids else [], strict=True):
            score, cand, _ = best_of_block_order(q, own, typed[0], doc_ids, typed[1], typed[2], k, block)
            raw, width = _pack(whole[None])
            best = [{"vec_id": i, "score": s} for i, s in zip(cand.tolist(), score.tolist(), strict=True)]
            out.append(nothing | {"run": run, "dim": dim, "width": width, "docs": raw, "ask": place + made["ask"], "id": own, "floor": int(score[-1]) if len(score) == k else LONG.min, "best": best})
            made["ask"] += 1
        return pd.DataFrame(out, columns=list(nothing))

    dim, held, n_docs, n_asks = None, ([], [], [], []), 0, 0
    for batch in batches:
        dims = batch.dim.to_numpy()
        for one in np.unique(dims):  # the stream is sorted by dim
            part = batch[dims == one]
            at = 0
            while at < len(part):
                if dim is not None and (one != dim or n_docs >= block * run_blocks or n_asks >= CHUNK):
                    yield flush(dim, *held)
                    held, n_docs, n_asks = ([], [], [], []), 0, 0
                dim = int(one)
                some = part.iloc[at : at + max(1, block * run_blocks - n_docs)]
                at += len(some)
                values = np.array(some.values_.tolist(), np.int64).reshape(len(some), dim)
                ids, asks = some.id.to_numpy(np.int64), some.asks.to_numpy(bool)
                for k_, x in enumerate((values[~asks], ids[~asks], values[asks], ids[asks])):
                    if len(x):
                        held[k_].append(x)
                n_docs, n_asks = n_docs + int((~asks).sum()), n_asks + int(asks.sum())
    if dim is not None:
        yield flush(dim, *held)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[bool, pd.DataFrame]]:
    """Pieces of a stream sorted by keys that hold one group each, and whether a group begins there."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        key = batch[keys].to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        for s, e in zip(new.tolist(), [*new[1:].tolist(), len(batch)], strict=True):
            yield last is None or (key[s] != last).any(), batch.iloc[s:e]
            last = key[s]


def _needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(run, chunk, ask) where a bound of the run reaches the floor of the query, but for its home."""
    asks: list[pd.DataFrame] = []
    for new, piece in _groups(batches, ["dim", "chunk", "part"]):
        if new:
            asks, ready = [], None
        is_ask = piece.ask.to_numpy() >= 0
        if is_ask.any():
            asks.append(piece[is_ask])
        blocks = piece[~is_ask]
        if not len(blocks) or not asks:
            continue
        dim = int(piece.dim.iloc[0])
        if ready is None:
            held = pd.concat(asks)
            queries = np.concatenate([_unpack(r, int(w), dim) for r, w in zip(held.docs, held.width, strict=True)])
            ready = held.ask.to_numpy(), held.run.to_numpy(), queries, held.floor.to_numpy()
        ask, home, queries, floor = ready
        maxima = np.stack([np.frombuffer(m, "<i8") for m in blocks.maxima])
        kind, runs = number_type(maxima, queries), blocks.run.to_numpy()
        top, low = maxima[:, :dim].astype(kind), maxima[:, dim:].astype(kind)
        # q * greatest where q > 0, q * least where not
        for first in range(0, len(queries), 256):
            q = queries[first : first + 256].astype(kind)
            zero = q * 0
            bound = np.where(q > 0, q, zero) @ top.T + np.where(q < 0, q, zero) @ low.T
            reach = np.stack([as_long(b) for b in bound]) >= floor[first : first + 256, None]
            where = np.argwhere(reach)
            found = pd.DataFrame({"run": runs[where[:, 1]], "chunk": int(piece.chunk.iloc[0]), "ask": ask[first + where[:, 0]], "_home": home[first + where[:, 0]]}).drop_duplicates()
            yield found[found.run != found._home][["run", "chunk", "ask"]]


def _tiles(batches: Iterator[pd.DataFrame], k: int, block: int) -> Iterator[pd.DataFrame]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for new, piece in _groups(batches, ["run", "chunk"]):
        if new:
            held, ready = [], None
        dim, is_ask = int(piece.dim.iloc[0]), piece.ask.to_numpy() >= 0
        for ids, raw, width, maxima in piece.loc[~is_ask, ["ids", "docs", "width", "maxima"]].itertuples(index=False):
            held.append((np.frombuffer(ids, "<i8"), _unpack(raw, int(width), dim), np.frombuffer(maxima, "<i8")))
        asks = piece[is_ask]
        if not len(asks):
            continue
        if ready is None:
            ready = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.stack([h[2] for h in held])
        ids, docs, maxima = ready
        queries = np.concatenate([_unpack(r, int(w), dim) for r, w in zip(asks.docs, asks.width, strict=True)])
        kind = number_type(docs, queries)
        typed, out = [x.astype(kind) for x in (docs, maxima[:, :dim], maxima[:, dim:], queries)], []
        for q, ask, own, floor in zip(typed[3], asks.ask.to_numpy(), asks.id.to_numpy(), asks.floor.tolist(), strict=True):
            score, cand, _ = best_of_block_order(q, own, typed[0], ids, typed[1], typed[2], k, block, floor)
            out.append(pd.DataFrame({"ask": ask, "query_id": own, "vec_id": cand, "score": score}))
        yield pd.concat(out)


def _ready(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    chosen = df.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col).alias("values_"))
    return chosen.where("id is not null and values_ is not null").withColumn("dim", F.size("values_"))


def index_of(vectors: DataFrame, queries: DataFrame, k: int, block: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Blocks of all vectors, and queries with their floors and the best of their home runs; written."""
    docs, asks = _ready(vectors, id_col, vector_col), _ready(queries, id_col, vector_col).distinct()
    code = F.array_join(F.transform(F.slice("values_", 1, SIGNS), lambda x: F.when(x < 0, "0").otherwise("1")), "").alias("code")
    every = docs.withColumn("asks", F.lit(False)).unionByName(asks.withColumn("asks", F.lit(True))).select("*", code)
    order = ["dim", "code", "id", "values_", "asks"]
    placed = every.repartitionByRange(n_partitions(vectors.sparkSession), *order).sortWithinPartitions(*order)
    run_blocks = RUN
    return written(placed.mapInPandas(lambda it: _indexed(it, k, block, run_blocks), INDEX))


def needed_runs(index: DataFrame) -> DataFrame:
    """(run, chunk, ask): the runs besides its home that a query has to see; written."""
    spark = index.sparkSession
    parts = n_partitions(spark)
    asks, blocks = index.where("ask >= 0"), index.where("ask < 0")
    chunks = max(1, -(-asks.count() // CHUNK))
    slices = max(1, -(-parts // chunks))
    spread = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    shared = asks.withColumns({"chunk": F.pmod(F.xxhash64("run"), F.lit(chunks)).cast("int"), "maxima": F.lit(None)}).select("*", spread(slices, "part"))
    shown = blocks.withColumns({"part": F.pmod(F.xxhash64("run"), F.lit(slices)).cast("int"), "docs": F.lit(None)}).select("*", spread(chunks, "chunk"))
    keys, columns = ["dim", "chunk", "part"], ["run", "width", "docs", "maxima", "ask", "floor"]
    met = shared.select(*keys, *columns).union(shown.select(*keys, *columns)).repartition(parts, *keys).sortWithinPartitions(*keys, F.col("ask") < 0, "run")
    return written(met.mapInPandas(_needed, "run long, chunk int, ask long"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products.

    Candidates are all rows but those with the query's own id. Vectors that are null or hold
    null or non-finite components take no part, nor do null ids; vectors of different lengths
    don't meet. Ties go to the smaller id, repeated candidates count as often as they occur,
    a repeated query id is answered once for each distinct vector it has, fewer than k
    candidates give fewer rows, and an empty table gives none. Scores are exact; components and
    scores beyond long count as its ends.
    """
    parts = n_partitions(vectors.sparkSession)
    index = index_of(vectors, queries, k, block, id_col, vector_col)
    asks, blocks = index.where("ask >= 0"), index.where("ask < 0")
    need = needed_runs(index)
    columns = ["run", "chunk", "dim", "block", "ids", "width", "docs", "maxima", "ask", "id", "floor"]
    goes = need.join(asks.drop("run"), "ask").select(*columns)
    stands = need.select("run", "chunk").distinct().join(blocks, "run").select(*columns)
    met = stands.union(goes).repartition(parts, "run", "chunk").sortWithinPartitions("run", "chunk", F.col("ask") >= 0, "block")
    found = met.mapInPandas(lambda it: _tiles(it, k, block), "ask long, query_id long, vec_id long, score long")
    at_home = asks.select("ask", F.col("id").alias("query_id"), F.inline("best"))
    w = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    best = found.unionByName(at_home).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op7(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))
