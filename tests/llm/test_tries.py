"""Prefix tries against a plain walk over all prefixes, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from siltworks.llm import tries

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, turns string, k1 int"


def ordered(rows):
    """Turns (role, text) of each conversation in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def plain_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_nodes(convs):
    """Rows of all nodes, by walking every prefix of every conversation."""
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        own = (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += not children[p]
    sha = lambda c: hashlib.sha256(",".join(map(str, sorted(c))).encode()).hexdigest()
    rows = [(len(p), min(m), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items()]
    return sorted(rows, key=str)


def conversations(n, seed):
    rng = random.Random(seed)
    say = [f"word{i} " * rng.randint(0, 4) for i in range(6)]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else ("user", "assistant")[t % 2], rng.choice(say[: 1 + c % 6])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("heavy, heavy_turns, shard", [(200, 4_000, 50_000), (2, 10**9, 20), (10, 25, 7), (10**9, 10**9, 10**9)])
def test_nodes_equal_a_plain_walk(spark, heavy, heavy_turns, shard):
    rows = conversations(90, 1)
    got = tries.trie_nodes(tries.rebuilt(tries.conversation_rows(frame(spark, rows))), heavy, heavy_turns, shard).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_nodes(plain_rebuilt(ordered(rows)))


def test_long_copies_and_odd_rows(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(11 if c % 3 else 23)]
    rows += [(100, None, "b", "first"), (100, None, "a", "second"), (100, -3, None, None), (100, -3, None, None), (101, 5, "", "")]
    rows += [(None, 1, "user", "nobody's"), (-7, 0, "user", "below zero"), (2**60, 1, "user", "w " * 5_000), (107, 0, "x", "é")]
    for heavy in (3, 200):
        got = tries.trie_nodes(tries.rebuilt(tries.conversation_rows(frame(spark, rows))), heavy).collect()
        # remainders are those of SQL: of the sign of the id
        convs = ordered(rows)
        want = plain_rebuilt({c: v for c, v in convs.items() if c >= 0})
        h = zlib.crc32(b"-7") % 4
        want[-7] = convs.get(0, [])[:h] + convs[-7][h:]
        assert sorted((tuple(r) for r in got), key=str) == plain_nodes(want)


def test_turnless_and_nothing(spark):
    turnless = spark.createDataFrame([(3, []), (4, [])], f"conv_id long, turns array<{tries.TURN}>")
    got = [tuple(r) for r in tries.trie_nodes(turnless).collect()]
    assert got == plain_nodes({3: [], 4: []})
    assert tries.trie_nodes(tries.conversation_rows(frame(spark, []))).collect() == []


def test_louds_form():
    lengths = np.array([2, 2, 1, 3])
    a = np.array([1, 2, 1, 3, 1, 9, 8, 7])
    trie = tries.Louds(np.array([[1, 0], [1, 0], [1, 0], [9, 0]]), lengths, a, a, np.ones(8, np.int64), np.array([4, 3, 2, 1]))
    assert trie.bits.astype(int).tolist() == [1, 1, 0, 1, 1, 0, 1, 0, 0, 0, 1, 0, 0]
    assert trie.parents().tolist() == [0, 0, 1, 1, 2, 5] and trie.children().tolist() == [2, 2, 1, 0, 0, 1, 0]
    assert trie.n_convs.tolist() == [4, 3, 1, 1, 1, 1, 1] and trie.least.tolist() == [1, 2, 1, 4, 3, 1, 1]
    assert trie.rolled_up(trie.children() == 0).tolist() == [3, 2, 1, 1, 1, 1, 1] and trie.reached.tolist() == [3, 4, 1, 6]


def test_pieces_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 50)
    convs = {c: [("user", "same")] for c in range(-50, 1_000, 3)}
    rows = [(c, 0, *t) for c, turns in convs.items() for t in turns]
    got = tries.trie_nodes(tries.conversation_rows(frame(spark, rows)), heavy=5).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_nodes(convs)
