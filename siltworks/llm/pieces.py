"""SentencePiece encoding with the n best segmentations, and decoding.

A text, with the dummy space in front, is a lattice of vocabulary pieces; characters without
a piece fall back to their UTF-8 bytes. The score of a segmentation is the sum of its pieces' scores.
The forward Viterbi pass gives the best score up to every position, which is an exact
heuristic for an A* search from the end: nodes come off the heap in order of the total of the
best path through them, so the first n that reach the start are the n best.

No piece has a space behind another character or holds a newline, so every path passes the
boundaries before runs of spaces and around newlines. The lattice is solved between these:
distinct segments of a batch go through the forward pass together in numpy, which also leaves
the gap to the best path that deviates. Of a text, only the n - 1 segments of least gap can
differ in its n best segmentations, and these alone are searched.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import table

MODEL = "piece_bpe_32k.model"
N_BEST = 4
CHARS = 4_000_000
SEGMENT = re.compile(r" *[^ \n]+| +|\n")
#: Segments beyond this length are solved one by one.
TOGETHER = 24

_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)


class Vocabulary:
    def __init__(self, path: str | None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(MODEL)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        text = [sp.id_to_piece(i).replace("▁", " ") for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte = {int(text[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.pieces = {text[i]: (i, float(sp.get_score(i))) for i in plain}
        if any(re.search(r"[^ ] |\n", t) for t in self.pieces):
            raise ValueError("a piece spans spaces or newlines: segments can't be solved apart")
        # pieces of -1e9 are barred from scoring; a character without a piece is worse than any other
        self.fallback = min(s for _, s in self.pieces.values() if s > -1e8) - 10
        self.longest = max(map(len, self.pieces))
        self.bytes_of = [bytes([int(t[1:-1], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else t.encode() for i, t in enumerate(text)]
        self._index()

    def _index(self):
        """Two tables by polynomial hash, so that each piece is in one of its two slots."""
        self.score = np.append(np.full(len(self.bytes_of), -np.inf), -np.inf)
        self.hash = np.zeros(len(self.bytes_of) + 1, np.uint64)
        none = len(self.bytes_of)
        self.slots = [np.full(1 << 20, none, np.int32), np.full(1 << 20, none, np.int32)]
        for t, (i, s) in self.pieces.items():
            h = 0
            for c in t:
                h = (h * int(_P) + ord(c) + 1) & (2**64 - 1)
            self.score[i], self.hash[i] = s, h
            h = h * int(_M) & (2**64 - 1)
            for slots, slot in zip(self.slots, (h >> 44, h >> 24 & 0xFFFFF), strict=True):
                if slots[slot] == none:
                    slots[slot] = i
                    break
            else:
                raise ValueError("no free slot for a piece")
        self.power = np.array([pow(int(_P), k, 2**64) for k in range(self.longest + 1)], np.uint64)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, or the id past the last."""
        m = h * _M
        i = self.slots[0][m >> np.uint64(44)]
        j = self.slots[1][(m >> np.uint64(24)) & np.uint64(0xFFFFF)]
        none = np.int32(len(self.bytes_of))
        return np.where(self.hash[i] == h, i, np.where(self.hash[j] == h, j, none))

    def fall_back(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()]

    def edges(self, s: str, e: int) -> Iterator[tuple[int, float, int | None]]:
        """(start, score, id or None for bytes) of the lattice's edges that end at e, longest first."""
        for b in range(max(0, e - self.longest), e):
            if found := self.pieces.get(s[b:e]):
                yield b, found[1], found[0]
            elif b == e - 1:
                yield b, self.fallback, None

    def forward(self, s: str) -> tuple[list[float], list, float]:
        """Best score up to each position, the edge it came by, and the gap to a deviating path."""
        best, back, second = [0.0], [None], [-np.inf]
        for e in range(1, len(s) + 1):
            top, two, via = -np.inf, -np.inf, None
            for b, w, i in self.edges(s, e):
                x = best[b] + w
                if x > top:
                    top, two, via = x, top, (b, i)
                elif x > two:
                    two = x
            best.append(top)
            back.append(via)
            second.append(two)
        gap, e = np.inf, len(s)
        while e:
            gap = min(gap, best[e] - second[e])
            e = back[e][0]
        return best, back, gap

    def spell(self, s: str, back: list) -> list[int]:
        out, e = [], len(s)
        while e:
            b, i = back[e]
            out += [i] if i is not None else self.fall_back(s[b:e])[::-1]
            e = b
        return out[::-1]

    @lru_cache(maxsize=100_000)  # noqa: B019  one vocabulary lives as long as its process
    def n_best(self, s: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of one segment, best first, by A* from its end."""
        best, _, _ = self.forward(s)
        heap, order, out = [(-best[-1], 0, len(s), 0.0, None)], 0, []
        while heap and len(out) < n:
            f, _, e, g, path = heapq.heappop(heap)
            if e == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                out.append((-f, ids))
                continue
            for b, w, i in self.edges(s, e):
                order += 1
                heapq.heappush(heap, (-(best[b] + w + g), order, b, g + w, ([i] if i is not None else self.fall_back(s[b:e]), path)))
        return out

    def solve(self, segments: list[str]):
        """(ids of all segments in a row, offsets, scores, gaps)."""
        lengths = np.array([len(s) for s in segments])
        ids: list = [None] * len(segments)
        score, gap = np.zeros(len(segments)), np.zeros(len(segments))
        for n in np.unique(lengths).tolist():
            group = np.flatnonzero(lengths == n)
            if n > TOGETHER or len(group) < 30:
                for k in group.tolist():
                    best, back, gap[k] = self.forward(segments[k])
                    score[k], ids[k] = best[-1], self.spell(segments[k], back)
                continue
            self._together(segments, group, n, ids, score, gap)
        count = np.array([len(x) for x in ids])
        return np.concatenate([np.asarray(x, np.int32) for x in ids]), np.concatenate([[0], np.cumsum(count)]), score, gap

    def _together(self, segments, group, n, ids, score, gap):
        words = [segments[k] for k in group.tolist()]
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).T.astype(np.uint64) + np.uint64(1)
        w, none = len(words), len(self.bytes_of)
        h = np.zeros((n + 1, w), np.uint64)
        for i in range(n):
            h[i + 1] = h[i] * _P + codes[i]
        best, second = np.full((n + 1, w), -np.inf), np.full((n + 1, w), -np.inf)
        best[0] = 0
        step, via = np.zeros((n + 1, w), np.int32), np.full((n + 1, w), none, np.int32)
        for e in range(1, n + 1):
            for size in range(min(e, self.longest), 0, -1):
                i = self.lookup(h[e] - h[e - size] * self.power[size])
                weight = self.score[i]
                if size == 1:
                    weight = np.where(i == none, self.fallback, weight)
                elif not (i != none).any():
                    continue
                x = best[e - size] + weight
                more = x > best[e]
                second[e] = np.where(more, best[e], np.maximum(second[e], x))
                best[e] = np.where(more, x, best[e])
                step[e] = np.where(more, size, step[e])
                via[e] = np.where(more, i, via[e])
        at, col, low = np.full(w, n), np.arange(w), np.full(w, np.inf)
        path = np.full((w, n), -1, np.int32)
        for k in range(n - 1, -1, -1):
            live = at > 0
            if not live.any():
                break
            path[live, k] = via[at[live], col[live]]
            low[live] = np.minimum(low[live], best[at[live], col[live]] - second[at[live], col[live]])
            at = at - np.where(live, step[at, col], 0)
        score[group], gap[group] = best[n], low
        bytes_in = (path == none).any(axis=1)
        kept = path >= 0
        flat, cuts = path[kept], np.cumsum(kept.sum(axis=1))[:-1]
        for k, own, fell, word in zip(group.tolist(), np.split(flat, cuts), bytes_in.tolist(), words, strict=True):
            if fell:
                own = self.spell(word, self.forward(word)[1])
            ids[k] = own

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> Vocabulary:
    return Vocabulary(path)


def _combined(vocab: Vocabulary, segments: list[str], order: list[int], offsets: np.ndarray, score: float, n: int):
    """The segmentations of a text after its best one: (score, [(at, drop, ids)]) each."""
    options = [vocab.n_best(segments[k], n) for k in order]
    start = (0,) * len(order)
    heap, seen, out = [(-score, start)], {start}, []
    while heap and len(out) < n:
        f, pick = heapq.heappop(heap)
        edits = [(int(offsets[k]), int(offsets[k + 1] - offsets[k]), options[x][p][1]) for x, (k, p) in enumerate(zip(order, pick, strict=True)) if p]
        out.append({"score": -f, "edits": [dict(zip(("at", "drop", "ids"), e, strict=True)) for e in edits]})
        for x, p in enumerate(pick):
            after = (*pick[:x], p + 1, *pick[x + 1 :])
            if p + 1 < len(options[x]) and after not in seen:
                seen.add(after)
                heapq.heappush(heap, (f + options[x][p][0] - options[x][p + 1][0], after))
    return out[1:]


def encode_texts(vocab: Vocabulary, texts: list[str | None], n_best: int) -> list[tuple]:
    """(ids, score, alternatives) for each text; all None for a null text."""
    parts = [SEGMENT.findall(" " + t) if t else [] for t in texts]
    known = {s: k for k, s in enumerate(dict.fromkeys(s for p in parts for s in p))}
    if known:
        flat, offsets, scores, gaps = vocab.solve(list(known))
    out = []
    for text, segments in zip(texts, parts, strict=True):
        if text is None:
            out.append((None, None, None))
            continue
        if not segments:
            out.append((np.zeros(0, np.int32), 0.0, []))
            continue
        own = np.fromiter(map(known.__getitem__, segments), np.int64, len(segments))
        count = offsets[own + 1] - offsets[own]
        ends = np.cumsum(count)
        ids = flat[np.arange(ends[-1]) + np.repeat(offsets[own] - ends + count, count)]
        score = float(scores[own].sum())
        more = []
        if n_best > 1:
            gap = gaps[own]
            order = np.argsort(gap, kind="stable")[: n_best - 1]
            order = order[np.isfinite(gap[order])]
            more = _combined(vocab, segments, order.tolist(), np.concatenate([[0], ends]), score, n_best)
        out.append((ids, score, more))
    return out


def _chunks(texts: list[str | None]) -> Iterator[slice]:
    start = total = 0
    for k, t in enumerate(texts):
        total += len(t or "")
        if total >= CHARS:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


SCHEMA = "ids array<int>, score double, alternatives array<struct<score:double,edits:array<struct<at:int,drop:int,ids:array<int>>>>>, round_trip boolean"


def encode_documents(docs: DataFrame, n_best: int = N_BEST, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, score, alternatives, round_trip) for every row of docs.

    ids is the best segmentation. alternatives has up to n_best - 1 more, best first, each as
    its score and the edits that make it: drop so many ids from position at, put ids there.
    round_trip tells whether decoding ids gives the text. Equal scores fall to the longer last piece.
    A null text has nulls, an empty one no ids and score 0; whole texts are encoded whatever
    their length, repeated rows alike, and an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(model_path)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch[text_col]]
            for part in _chunks(texts):
                out = encode_texts(vocab, texts[part], n_best)
                right = [None if i is None else vocab.decode(i.tolist()) == t for (i, _, _), t in zip(out, texts[part], strict=True)]
                yield pd.DataFrame(
                    {
                        id_col: batch[id_col].iloc[part],
                        "ids": pd.Series([x[0] for x in out], index=batch.index[part], dtype=object),
                        "score": pd.Series([x[1] for x in out], index=batch.index[part], dtype=float),
                        "alternatives": pd.Series([x[2] for x in out], index=batch.index[part], dtype=object),
                        "round_trip": pd.Series(right, index=batch.index[part], dtype=object),
                    }
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInPandas(run, f"`{id_col}` {kind}, {SCHEMA}")


def decode_documents(encoded: DataFrame, model_path: str | None = None, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """encoded with the text its ids stand for; null ids are a null text."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        vocab = vocabulary(model_path)
        return pd.Series([None if i is None else vocab.decode(list(i)) for i in ids], dtype=object)

    return encoded.withColumn(text_col, decode(ids_col))


def op4(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).withColumn("n_pieces", F.size("ids"))
