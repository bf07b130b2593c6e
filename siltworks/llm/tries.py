"""Prefix tries of conversations as succinct level-order tries, with rolled-up totals.

A conversation is a sequence of turns, and a node is a sequence that some conversation begins
with; the root is the empty one. A turn is known by two 64-bit hashes of its role and text, and a
node by two 64-bit hashes chained over its turns, so texts are read once and never shuffled.

Prefixes of many conversations are heavy. They are found from the root on, LEVELS levels at a
time, and only conversations below a heavy node go on to the next ones. What hangs below the
heavy levels are units of bounded size, one for each first prefix that isn't heavy. Units are dealt
to shards, and a shard is one trie in LOUDS form: bits that give every node's number of children
in breadth-first order, and arrays of labels. Parents and children come from ranks in the bits, and
totals go up by adding each level to the one above, deepest first.

The heavy nodes are few and merged apart: what a node has of its own, with the totals of the units
below it, is added to all its ancestors. Numbers of conversations that end at heavy nodes are made
into text in ranges of ids, and the pieces of a node are hashed in order as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import cut, n_partitions, table, word_count, written

#: A prefix that two or more begin with is heavy beyond so many conversations, or turns from it on.
HEAVY, HEAVY_TURNS = 200, 4_000
LEVELS = 4
#: Turns of a shard on average.
SHARD = 50_000
#: Bytes of ids in a piece, and in all pieces that a task holds.
PIECE, PIECES = 1 << 16, 1 << 24
NOTHING = hashlib.sha256(b"").hexdigest()
TURN = "struct<a:bigint,b:bigint,words:bigint>"
KEY = ["depth", "k1", "k2"]


def conversation_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): for each conversation its turns in order, as hashes and numbers of words.

    Turns are in order of their numbers, null first. Equal numbers are in order of role and text,
    which only such rows take along. Null roles and texts are empty ones; rows without a
    conversation's id belong to none and are left out; repeated rows are turns of their own.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    plain = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    tied = cut(plain.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1").select("conv_id", "turn", F.lit(True).alias("tied")))
    if tied.isEmpty():
        tie = plain.withColumn("tie", F.lit(None).cast("struct<role:string,text:string>"))
    else:
        other = tied.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "tied")
        joined = plain.join(other, (plain["conv_id"] == other["_c"]) & plain["turn"].eqNullSafe(other["_t"]), "left")
        tie = joined.withColumn("tie", F.when(F.col("tied"), F.struct("role", "text")))
    seen = F.struct(F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "text", "role").alias("b"), word_count(F.col("text")).alias("words"))
    row = tie.select("conv_id", F.struct(F.col("turn").isNotNull().alias("is"), "turn", "tie", seen.alias("seen")).alias("x"))
    return row.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x")).select("conv_id", F.col("x.seen").cast(f"array<{TURN}>").alias("turns"))


def _chained(k1: Column, k2: Column, turn: Column) -> tuple[Column, Column]:
    return F.xxhash64(k1, turn["a"], turn["b"]), F.xxhash64(k2, turn["b"], turn["a"])


def _levels(depth: int) -> Column:
    """The prefixes of a row's next levels, each with those above it as its path."""
    node = "struct<depth:int,k1:bigint,k2:bigint>"
    path, k1, k2, found = F.col("path"), F.col("k1"), F.col("k2"), []
    for d in range(depth, depth + LEVELS):
        turn = F.get("turns", F.lit(d))
        k1, k2 = _chained(k1, k2, turn)
        here = F.struct(F.lit(d + 1).alias("depth"), k1.alias("k1"), k2.alias("k2")).cast(node)
        path = F.concat(path, F.array(here))
        found.append(F.when(F.col("n") > d, F.struct(F.lit(d + 1).alias("depth"), k1.alias("k1"), k2.alias("k2"), turn["words"].alias("words"), path.alias("path"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def split_heavy(rows: DataFrame, first: int, heavy: int, heavy_turns: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heavy nodes, conversations that end at a heavy node, those that go on below one).

    The root counts as heavy; `first` is its smallest conversation. The second and third hold the
    last heavy node of each conversation, and the third the turns behind it.
    """
    node = "struct<depth:int,k1:bigint,k2:bigint>"
    root = F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).alias("k1"), F.lit(0).alias("k2")).cast(node))
    active = rows.select("conv_id", "turns", F.size("turns").alias("n"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(first).cast("long").alias("of"), root.alias("path"))
    nodes, ended, below, depth = [], [], [], 0
    while True:
        levels = active.select("conv_id", "n", F.inline(_levels(depth)))
        some = levels.groupBy(*KEY).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("of"), F.sum(F.col("n") - F.col("depth") + 1).alias("turns"), F.max("words").alias("words"), F.first("path").alias("path"))
        found = cut(some.where((F.col("n_convs") > 1) & ((F.col("n_convs") > heavy) | (F.col("turns") > heavy_turns))).drop("turns"))
        nodes.append(found)
        if found.isEmpty():
            last = active.withColumn("deep", F.lit(depth))
        else:
            last_of = levels.select("conv_id", *KEY).join(found.select(*KEY, "of", "path"), KEY).groupBy("conv_id").agg(F.max_by(F.struct("depth", "k1", "k2", "of", "path"), "depth").alias("x"))
            last = active.join(last_of, "conv_id", "left").select(
                "conv_id", "turns", "n", F.coalesce("x.depth", F.lit(depth)).alias("deep"), *[F.coalesce(F.col(f"x.{c}"), F.col(c)).alias(c) for c in ("k1", "k2", "of", "path")]
            )
            last = written(last)
        ended.append(last.where("n = deep").select("conv_id", F.col("deep").alias("depth"), "k1", "k2"))
        on = last.where((F.col("n") > F.col("deep")) & (F.col("deep") < depth + LEVELS))
        below.append(on.select("conv_id", "deep", "k1", "k2", "of", F.slice("turns", F.col("deep") + 1, F.col("n") - F.col("deep")).alias("turns")))
        if found.isEmpty():
            break
        active = last.where((F.col("n") > F.col("deep")) & (F.col("deep") == depth + LEVELS)).drop("deep")
        depth += LEVELS
        if active.isEmpty():
            break
    return tuple(reduce(DataFrame.unionByName, parts) for parts in (nodes, ended, below))


class Louds:
    """Tries in level order: node 0 stands above all, and the children of a node lie side by side.

    `bits` has a 1 for every child of a node and then a 0, node by node; `words` are
    labels, `level` has the first node of each level. `some` is a sequence through each node, and
    `reached` the node at which each sequence ends.
    """

    def __init__(self, roots: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, words: np.ndarray, ids: np.ndarray):
        starts = np.cumsum(lengths) - lengths
        at, live, self.level, count = np.zeros(len(lengths), np.int64), np.arange(len(lengths)), [0], 1
        degrees, label_words, convs, least = [], [np.zeros(1, np.int64)], [np.array([len(lengths)])], [ids.min(keepdims=True) if len(ids) else np.zeros(1, np.int64)]
        some, depth = [np.zeros(1, np.int64)], 0
        while len(live):
            self.level.append(count)
            x, y = (roots[live, 0], roots[live, 1]) if depth == 0 else (a[starts[live] + depth], b[starts[live] + depth])
            order = np.lexsort((y, x, at[live]))
            up, x, y = at[live][order], x[order], y[order]
            new = np.concatenate([[True], (up[1:] != up[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            begins = np.flatnonzero(new)
            own = live[order]
            above = self.level[-2]
            degrees.append(np.bincount(up[begins] - above, minlength=count - above))
            some.append(own[begins])
            label_words.append(words[starts[some[-1]] + depth])
            convs.append(np.diff(np.append(begins, len(own))))
            least.append(np.minimum.reduceat(ids[own], begins))
            at[own] = count + np.cumsum(new) - 1
            count += len(begins)
            depth += 1
            live = live[lengths[live] > depth]
        degrees.append(np.zeros(count - self.level[-1], np.int64))
        degree = np.concatenate(degrees)
        self.bits = np.ones(2 * count - 1, bool)
        self.bits[np.cumsum(degree + 1) - 1] = False
        self.words, self.n_convs, self.least, self.some = map(np.concatenate, (label_words, convs, least, some))
        self.reached = at

    def parents(self) -> np.ndarray:
        """Of every node but the first: how many nodes' bits have ended before its own 1."""
        ones = np.flatnonzero(self.bits)
        return ones - np.arange(len(ones))

    def children(self) -> np.ndarray:
        ends = np.flatnonzero(~self.bits)
        return np.diff(ends, prepend=-1) - 1

    def rolled_up(self, own: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out, up, ends = own.astype(np.int64), self.parents(), [*self.level[1:], len(own)]
        for lo, hi in zip(self.level[:0:-1], ends[:0:-1], strict=True):
            np.add.at(out, up[lo - 1 : hi - 1], out[lo:hi])
        return out


NODE = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODES = pa.schema([*((c, pa.int64()) for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()), ("p1", pa.int64()), ("p2", pa.int64()), ("top", pa.bool_())])


def _long(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _shard(rows: pa.Table) -> pa.Table:
    """The nodes of a shard's units."""
    ids, deep, of, p1, p2 = (_long(rows[c]) for c in ("conv_id", "deep", "of", "p1", "p2"))
    a, b, words = (_long(pc) for pc in (pa.chunked_array([x.flatten() for x in rows[c].chunks], pa.int64()) for c in ("a", "b", "words")))
    lengths = np.concatenate([np.diff(x.offsets.to_numpy()) for x in rows["a"].chunks]).astype(np.int64)
    trie = Louds(np.column_stack([_long(rows["k1"]), _long(rows["k2"])]), lengths, a, b, words, ids)
    n_children, up = trie.children(), trie.parents()
    leaves, saved = trie.rolled_up(n_children == 0), trie.rolled_up((trie.n_convs - 1) * trie.words)
    some = trie.some
    level = np.repeat(np.arange(len(trie.level)), np.diff([*trie.level, len(some)]))
    by = np.lexsort((ids, trie.reached))
    ends, cuts = np.full(len(some), NOTHING, object), np.flatnonzero(np.diff(trie.reached[by], prepend=-1))
    for s, e in zip(cuts, [*cuts[1:], len(by)], strict=True):
        ends[trie.reached[by[s]]] = hashlib.sha256(",".join(map(str, ids[by[s:e]].tolist())).encode()).hexdigest()
    top = level[1:] == 1
    parent = np.where(top, of[some[1:]], trie.least[up])
    whole = [deep[some[1:]] + level[1:], trie.least[1:], parent, trie.n_convs[1:], n_children[1:], leaves[1:], saved[1:], ends[1:], p1[some[1:]], p2[some[1:]], top]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(whole, _NODES, strict=True)], schema=_NODES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node in the order that they come, joined into pieces."""
    held: dict[tuple, list] = {}
    total = 0

    def rows(keys):
        done = [(*k, held[k][0], ",".join(held[k][1])) for k in keys]
        for k in keys:
            del held[k]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[*KEY, "first", "piece"])

    for batch in batches:
        for i, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, parts, size = held.get(tuple(key), (i, [], 0))
            parts.append(str(i))
            held[tuple(key)] = (first, parts, size + len(parts[-1]) + 1)
            total += len(parts[-1]) + 1
            if held[tuple(key)][2] >= PIECE:
                total -= held[tuple(key)][2]
                yield rows([tuple(key)])
        if total >= PIECES:
            yield rows(list(held))
            total = 0
    if held:
        yield rows(list(held))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, from a stream in order of node and piece."""
    last, sha = None, None
    one = lambda: pa.record_batch([pa.array([x], t) for x, t in zip((*last, sha.hexdigest()), (pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[*KEY, "ends_sha256"])
    for batch in batches:
        for depth, k1, k2, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (depth, k1, k2) != last:
                if last is not None:
                    yield one()
                last, sha = (depth, k1, k2), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.encode())
    if last is not None:
        yield one()


def end_hashes(ended: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (conv_id, node): ids joined in order, however many a node has."""
    parts = n_partitions(ended.sparkSession)
    ranged = ended.select("conv_id", *KEY).repartitionByRange(parts, "conv_id").sortWithinPartitions("conv_id")
    pieces = ranged.mapInArrow(_pieces, "depth int, k1 long, k2 long, first long, piece string")
    return pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, "depth int, k1 long, k2 long, ends_sha256 string")


def trie_nodes(rows: DataFrame, heavy: int = HEAVY, heavy_turns: int = HEAVY_TURNS, shard: int = SHARD) -> DataFrame:
    """All nodes of the trie of conversations (conv_id, turns), from `conversation_rows` or alike.

    Ids are distinct longs. A node has its smallest conversation and that of its parent (null for
    the root), its depth, the conversations that begin with it, its children, the leaves and the
    saved words of its subtree, itself included, and the hash of the ids that end at it. Saved are
    the words of a node's last turn for every conversation but one. Without conversations there
    is no node, not even the root; conversations without turns end at the root.
    """
    spark = rows.sparkSession
    rows = written(rows)
    whole = rows.agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.sum(F.size("turns")).alias("turns")).first()
    if not whole["n"]:
        return spark.createDataFrame([], NODE)
    nodes, ended, below = split_heavy(rows, whole["first"], heavy, heavy_turns)
    k1, k2 = _chained(F.col("k1"), F.col("k2"), F.get("turns", F.lit(0)))
    units = below.select("conv_id", "deep", "of", F.col("k1").alias("p1"), F.col("k2").alias("p2"), k1.alias("k1"), k2.alias("k2"), *[F.col(f"turns.{c}").alias(c) for c in ("a", "b", "words")])
    shards = max(n_partitions(spark), -(-whole["turns"] // shard))
    dealt = units.withColumn("shard", F.pmod(F.xxhash64("k1", "k2"), F.lit(shards)).cast("int"))
    light = written(dealt.groupBy("shard").applyInArrow(_shard, f"{NODE}, p1 long, p2 long, top boolean"))

    node = "struct<depth:int,k1:bigint,k2:bigint>"
    root = spark.range(1).select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(whole["n"]).cast("long").alias("n_convs"), F.lit(whole["first"]).cast("long").alias("of"), F.lit(0).cast("long").alias("words"), F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).alias("k1"), F.lit(0).alias("k2")).cast(node)).alias("path"))
    upper = nodes.unionByName(root).withColumn("up", F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1)))
    tops = light.where("top").groupBy((F.col("depth") - 1).cast("int").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("below"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    inner = upper.where("up is not null").groupBy("up").agg(F.count("*").alias("inner")).select("up.*", "inner")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    own = upper.join(tops, KEY, "left").join(inner, KEY, "left").withColumn("n_children", zero("below") + zero("inner"))
    own = cut(own.withColumns({"leaves": F.when(F.col("n_children") == 0, 1).otherwise(zero("leaves")), "saved": zero("saved") + (F.col("n_convs") - 1) * F.col("words")}))
    total = own.select(F.explode("path").alias("x"), "leaves", "saved").groupBy("x").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")).select("x.*", "n_leaves", "saved_tokens")
    named = own.select(*[F.col(c).alias(f"up_{c}") for c in KEY], F.col("of").alias("parent_conv_id"))
    parent = F.col("up.depth").eqNullSafe(F.col("up_depth")) & (F.col("up.k1") == F.col("up_k1")) & (F.col("up.k2") == F.col("up_k2"))
    heavy_rows = own.join(named, parent, "left").join(total, KEY).join(end_hashes(ended), KEY, "left")
    heavy_nodes = heavy_rows.select(F.col("depth").cast("long"), F.col("of").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    return light.drop("p1", "p2", "top").unionByName(heavy_nodes)


def rebuilt(rows: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with the first h turns of its group's first one in place of its own, h by its id."""
    rows = written(rows)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    of = F.col("conv_id") - F.col("conv_id") % group
    heads = rows.where(of == F.col("conv_id")).select(F.col("conv_id").alias("of"), F.slice("turns", 1, most - 1).alias("head"))
    whole = rows.select("conv_id", "turns", h.alias("h"), of.alias("of")).join(heads, "of", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(f"array<{TURN}>"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return whole.select("conv_id", F.concat(head, rest).alias("turns"))


def op13(spark, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(conversation_rows(table(spark, sf_dir, "conversations"))))
