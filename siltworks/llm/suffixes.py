"""Removal of repeated byte strings with a column-wise multi-document suffix order.

A byte goes if a string of WIDTH bytes covers it that also starts in a document with a smaller
id. Strings of equal bytes are found from the suffix order of the collection, built column by
column: each round puts one more symbol in front of every string's suffix, places the new
suffixes in the Burrows-Wheeler transform by counting symbols before the last ones, and brings
the common prefixes of neighbours up to date from their minimum in between. Each round is one
sequential pass that reads the transform, the prefixes and the suffix numbers and writes them
anew. Runs of common prefixes of WIDTH or more are equal strings.

One order of all suffixes would be a single task, so the collection is dealt out first. Every
window of WIDTH bytes belongs to its minimizer, the K bytes in it of least hash. Neighbouring windows that
share it form one piece of text, and pieces are dealt to buckets by the hash of these K bytes:
equal windows always meet in one bucket. A bucket's size is set by the number of buckets,
which follows the input. A bucket has pieces only, equal ones of a chunk of text once, and a piece
whose surroundings of the minimizer occur in no other document is left out, as no window of it
can recur; what no other piece can have of a piece is not put in order. It gives a mask for each distinct piece: by window, the smallest id that has it. A
second pass over the texts deals the places where pieces occur, those of a bucket with many to
several tasks, and there the masks are laid over them, one chunk of text at a time.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import cut, table

WIDTH = 50
K = 12
SPAN = WIDTH - K + 1
#: The minimizer and half of what else a window holds.
SIDE = K + (WIDTH - K) // 2
#: Bytes of text that a map task works on at a time, and aimed at for a bucket.
CHUNK = 2 << 20
BUCKET = 12 << 20
#: A task packs so many chunks' share of a bucket into one row.
PACKED = 8
#: Places of pieces aimed at for a task; a bucket with more is dealt to several.
RUNS = 1_000_000

_U = np.uint64
_P = 0x9E3779B97F4A7C15


def _pow(n: int) -> np.uint64:
    return _U(pow(_P, n, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Hashes:
    """Polynomial hashes of all strings of 1, 2, 4, ... bytes of a text, and of others at given starts.

    Those below `least` aren't kept.
    """

    def __init__(self, data: np.ndarray, most: int, least: int = 1):
        h, n = data.astype(np.uint64), 1
        h += _U(1)
        self.powers = {1: h} if least == 1 else {}
        while 2 * n <= most:
            longer = h[:-n] * _pow(n)
            longer += h[n:]
            n, h = 2 * n, longer
            self.powers[n] = h

    def all(self, width: int) -> np.ndarray:
        """Hashes of all strings of a width, by start."""
        out, done = None, 0
        for n in sorted(self.powers, reverse=True):
            while width - done >= n:
                part = self.powers[n][done:]
                out = part if out is None else out[: len(part)] * _pow(n) + part[: len(out)]
                done += n
        return out

    def at(self, starts: np.ndarray, width: int) -> np.ndarray:
        out, done = np.zeros(len(starts), np.uint64), 0
        for n in sorted(self.powers, reverse=True):
            while width - done >= n:
                out = out * _pow(n) + self.powers[n][starts + done]
                done += n
        return out


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each of the lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _pack(parts: list[tuple[np.ndarray, ...]]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts, protocol=5))


def _unpack(blob: bytes) -> list[tuple[np.ndarray, ...]]:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _pieces(parts: list[bytes], doc_ids: np.ndarray, uids: np.ndarray, bases: np.ndarray, buckets: int, salts: dict[int, int] | None) -> Iterator[tuple]:
    """(bucket, number of places, pieces) of some texts, or parts of texts that start at `bases`.

    With salts, the number of tasks of each bucket that has more than one, the places instead:
    (bucket, salt, places).
    """
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(parts), np.uint8)
    if len(data) < WIDTH:
        return
    hashes = Hashes(data, 32, 2)
    key = _mix(hashes.all(K))
    # of a chunk's large arrays only those read below stay: workers share an executor's memory
    for width in (4, 8):
        del hashes.powers[width]
    low = key & ~_U((1 << 24) - 1)
    low |= np.arange(len(key), dtype=np.uint64)
    n = 1
    while 2 * n <= SPAN:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if SPAN > n:
        low = np.minimum(low[: n - SPAN], low[SPAN - n :])
    windows = len(data) - WIDTH + 1
    low &= _U((1 << 24) - 1)
    at = low[:windows].astype(np.int32)
    del low
    long = sizes >= WIDTH
    change = np.zeros(windows + 1, np.int8)
    change[(ends - sizes)[long]] = 1
    change[(ends - WIDTH + 1)[long]] = -1
    inside = np.cumsum(change, dtype=np.int8) > 0
    first = inside[:windows].copy()
    first[1:] &= (at[1:] != at[:-1]) | ~inside[: windows - 1]
    # windows of two texts are always apart: between them lie windows that are in neither
    start = np.flatnonzero(first)
    if not len(start):
        return
    stop = np.flatnonzero(first | ~inside[:windows])
    stop = np.append(stop, windows)
    count = stop[np.searchsorted(stop, start, "right")] - start
    anchor = at[start].astype(np.int64)
    del at
    bucket = (_mix(key[anchor] ^ _U(_P)) % _U(buckets)).astype(np.int64)
    same = _mix(hashes.at(start, WIDTH) * _U(3) + hashes.at(start + count - 1, WIDTH) * _U(5) + (count + WIDTH - 1).astype(np.uint64))
    owner = np.searchsorted(ends, start, "right")
    _, rep, member = np.unique(same, return_index=True, return_inverse=True)
    # pieces by bucket and place, so that the numbers below grow slowly and pack well
    order = np.lexsort((rep, bucket[rep]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rep, member = rep[order], place[member]
    rep_bucket, run_bucket = bucket[rep], bucket
    by_bucket = np.argsort(run_bucket, kind="stable")
    run_bucket = run_bucket[by_bucket]
    doc_start = ends - sizes
    for b in np.unique(rep_bucket).tolist():
        lo, hi = np.searchsorted(rep_bucket, [b, b + 1])
        chosen = rep[lo:hi]
        length = count[chosen] + WIDTH - 1
        runs = by_bucket[slice(*np.searchsorted(run_bucket, [b, b + 1]))]
        if salts is None:
            ids, nth = np.unique(doc_ids[owner[runs]], return_inverse=True)
            own = member[runs] - lo
            least, most = np.full(hi - lo, len(ids)), np.full(hi - lo, -1)
            np.minimum.at(least, own, nth)
            np.maximum.at(most, own, nth)
            yield b, len(runs), (
                data[_spread(start[chosen], length)],
                length.astype(np.uint8),
                (anchor[chosen] - start[chosen]).astype(np.uint8),
                np.diff(least, prepend=0).astype(np.int32),
                (most - least).astype(np.int32),
                ids,
            )
            continue
        docs, doc = np.unique(owner[runs], return_inverse=True)
        yield b, int(uids[docs[0]]) % salts.get(b, 1), (
            same[chosen],
            np.diff(member[runs] - lo, prepend=0).astype(np.int32),
            np.diff(doc, prepend=0).astype(np.int32),
            np.diff(start[runs], prepend=0).astype(np.int32),
            doc_ids[docs],
            uids[docs],
            (doc_start - bases)[docs],
        )


def _mapped(batches: Iterator[pd.DataFrame], buckets: int, salts: dict[int, int] | None = None) -> Iterator[pd.DataFrame]:
    held, total, chunks = [], 0, 0
    #: by bucket (and salt) the number of places and the parts of the chunks since rows were made
    made: dict[tuple, list] = {}

    def flush():
        for b, n, part in _pieces([h[0] for h in held], np.array([h[1] for h in held]), np.array([h[2] for h in held]), np.array([h[3] for h in held]), buckets, salts):
            row = made.setdefault((b,) if salts is None else (b, n), [0, []])
            row[0] += n
            row[1].append(part)
        held.clear()

    def rows():
        out = [(key[0], n if salts is None else key[1], _pack(parts)) for key, (n, parts) in made.items()]
        made.clear()
        return pd.DataFrame(out, columns=["bucket", "runs" if salts is None else "salt", "blob"])

    for batch in batches:
        for doc_id, uid, text in zip(batch.doc_id, batch.uid, batch.text, strict=True):
            raw = text.encode()
            # parts of a long text overlap so that each window is in just one of them
            for base in range(0, max(1, len(raw) - WIDTH + 1), CHUNK):
                part = raw[base : base + CHUNK + WIDTH - 1]
                if len(part) >= WIDTH:
                    held.append((part, doc_id, uid, base))
                    total += len(part)
                if total >= CHUNK:
                    flush()
                    total, chunks = 0, chunks + 1
                    if chunks % PACKED == 0:
                        yield rows()
    if held:
        flush()
    yield rows()


def suffix_order(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a collection of strings in order: (string, start, common prefix with the one before).

    text holds the strings one after another; bytes 0xFF don't occur in it. Common prefixes
    stop at 255. The empty suffixes, which come first, are left out.
    """
    m = len(lengths)
    ends = np.cumsum(lengths)
    symbols = np.where(text == 0, np.uint8(255), text)
    bwt = symbols[ends - 1]
    lcp = np.zeros(m, np.uint8)
    # a suffix is its string and its length, in one number
    suffix = np.arange(m, dtype=np.int32 if m < 1 << 23 else np.int64) << 8
    live = np.arange(m)
    while len(live):
        active = np.zeros(len(bwt), bool)
        active[live] = True
        order = np.argsort(bwt, kind="stable")
        order = order[np.count_nonzero(bwt == 0) :]
        new = active[order]
        rank = np.flatnonzero(new)
        rows = order[rank]
        n = m + len(order)
        fresh = np.zeros(n, bool)
        fresh[m + rank] = True
        # rows whose neighbour before them is new or which are new themselves
        changed = new.copy()
        changed[1:] |= new[:-1]
        changed = np.flatnonzero(changed)
        prefix = np.zeros(len(changed), np.uint8)
        here, before = order[changed], order[np.maximum(changed - 1, 0)]
        alike = (changed > 0) & (bwt[here] == bwt[before])
        if alike.any():
            lo, hi = before[alike] + 1, here[alike] + 1
            down = np.argsort(-lo, kind="stable")  # falling starts: what lies between two ranges is not read
            bounds = np.empty(2 * len(down), np.int64)
            bounds[0::2], bounds[1::2] = lo[down], hi[down]
            least = np.empty(len(down), np.uint8)
            least[down] = np.minimum.reduceat(np.append(lcp, np.uint8(0)), bounds)[0::2]
            prefix[alike] = np.minimum(least, 254) + np.uint8(1)
        string = suffix[rows] >> 8
        length = (suffix[rows] & 255) + 1
        at = ends[string] - length - 1
        following = np.where(length < lengths[string], symbols[np.maximum(at, 0)], np.uint8(0))
        merged, stay = [], ~fresh
        for old, put in ((bwt, following), (suffix, string << 8 | length), (lcp, None)):
            out = np.empty(n, old.dtype)
            out[stay] = old
            if put is not None:
                out[fresh] = put
            merged.append(out)
        bwt, suffix, lcp = merged
        lcp[m + changed] = prefix
        live = (m + rank)[following != 0]
    suffix, lcp = suffix[m:], lcp[m:]
    string = suffix >> 8
    return string, lengths[string] - (suffix & 255), lcp


def _marks(text: np.ndarray, begin: np.ndarray, length: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece a hash of all of it, and of the SIDE bytes up to and from its minimizer.

    A side that reaches beyond the piece has a hash without meaning.
    """
    out = np.zeros((3, len(begin)), np.uint64)
    for first in range(0, len(begin), 10_000):
        part = slice(first, first + 10_000)
        start = begin[part] - begin[first]
        size, at = length[part], start + offset[part]
        hashes = Hashes(text[begin[first] : begin[part][-1] + size[-1]], 32)
        end = start + size
        out[0, part] = _mix(hashes.at(start, WIDTH) * _U(3) + hashes.at(end - WIDTH, WIDTH) * _U(5) + size.astype(np.uint64))
        out[1, part] = hashes.at(np.maximum(start, at - (SIDE - K)), SIDE)
        out[2, part] = hashes.at(np.minimum(end - SIDE, at), SIDE)
    return out[0], out[1], out[2]


def _compared(offset: np.ndarray, count: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each piece that other pieces may have, and the one behind the last.

    left and right tell whether other pieces have the bytes on that side of the minimizer. Windows up
    to turn - 1 hold all of the left side, the others all of the right one.
    """
    turn = np.clip(offset - (SIDE - K) + 1, 0, count)
    return np.where(left, 0, turn), np.where(right, count, turn)


def _bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """The number of places of one bucket, and packed masks of its distinct pieces.

    Of each piece with a window that goes somewhere: its hash, its number of windows and, by
    window, the smallest id that has it.
    """
    out = lambda blob: pd.DataFrame({"bucket": frame.bucket[:1], "runs": [int(frame.runs.sum())], "blob": pd.Series([blob], dtype=object)})
    blobs = [part for b in frame.blob for part in _unpack(b)]
    text, length, offset = (np.concatenate([b[k] for b in blobs]) for k in range(3))
    length, offset = length.astype(np.int64), offset.astype(np.int64)
    low = [np.cumsum(b[3], dtype=np.int64) for b in blobs]
    every_most = np.concatenate([b[5][x + b[4]] for b, x in zip(blobs, low, strict=True)])
    every_least = np.concatenate([b[5][x] for b, x in zip(blobs, low, strict=True)])
    del blobs, low
    begin = np.cumsum(length) - length
    same, left, right = _marks(text, begin, length, offset)
    same, rep, to = np.unique(same, return_index=True, return_inverse=True)
    begin, length, offset, left, right = begin[rep], length[rep], offset[rep], left[rep], right[rep]
    least, most = np.full(len(rep), np.iinfo(np.int64).max), np.full(len(rep), np.iinfo(np.int64).min)
    np.minimum.at(least, to, every_least)
    np.maximum.at(most, to, every_most)
    # a window holds the minimizer and WIDTH - K more bytes, so half of these lie to one side of it
    keep = least < most
    # whether other pieces, in other documents, have the same bytes on that side
    meets = np.zeros((2, len(rep)), bool)
    for other, has, mark in ((meets[0], offset >= SIDE - K, left), (meets[1], offset + SIDE <= length, right)):
        has = np.flatnonzero(has)
        _, group, pieces = np.unique(mark[has], return_inverse=True, return_counts=True)
        lo, hi = np.full(len(has), np.iinfo(np.int64).max), np.full(len(has), np.iinfo(np.int64).min)
        np.minimum.at(lo, group, least[has])
        np.maximum.at(hi, group, most[has])
        apart = lo[group] < hi[group]
        keep[has] |= apart
        other[has] = apart & (pieces[group] > 1)
    kept = np.flatnonzero(keep)
    if not len(kept):
        return out(None)
    count = length[kept] - WIDTH + 1
    first_of = np.cumsum(count) - count
    # a window that no other piece can have is where its own piece is
    source = np.repeat(least[kept], count)
    lo, hi = _compared(offset[kept], count, *meets[:, kept])
    ordered = np.flatnonzero(lo < hi)
    if len(ordered):
        lo, size = lo[ordered], (hi - lo)[ordered] + WIDTH - 1
        string, at, lcp = suffix_order(text[_spread(begin[kept][ordered] + lo, size)], size)
        windows = at + WIDTH <= size[string]
        # equal windows are neighbours: between them no common prefix is shorter than WIDTH
        group = np.cumsum(lcp < WIDTH)[windows]
        string, at = string[windows], at[windows]
        heads = np.flatnonzero(np.diff(group, prepend=-1))
        smallest = np.minimum.reduceat(least[kept][ordered][string], heads)
        source[(first_of[ordered] + lo)[string] + at] = np.repeat(smallest, np.diff(np.append(heads, len(group))))

    goes = np.bitwise_or.reduceat(source < np.repeat(most[kept], count), first_of)
    if not goes.any():
        return out(None)
    return out(_pack([(same[kept][goes], count[goes].astype(np.uint8), source[_spread(first_of[goes], count[goes])])]))


def _masked(places: pd.DataFrame, masks: pd.DataFrame, doc_parts: int) -> pd.DataFrame:
    """Spans to remove, packed by part of the documents, at some places of one bucket."""
    none = pd.DataFrame({"part": pd.Series([], dtype="int32"), "blob": pd.Series([], dtype=object)})
    if not len(masks):
        return none
    ((keys, count, source),) = _unpack(masks.blob.iloc[0])
    count = count.astype(np.int64)
    first_of = np.cumsum(count) - count
    found = [x for blob in places.blob for part in _unpack(blob) if len((x := _laid(part, keys, count, first_of, source))[0])]
    if not found:
        return none
    uid, lo, hi = (np.concatenate(x) for x in zip(*found, strict=True))
    return _by_part(uid, lo, hi, doc_parts)


def _laid(chunk: tuple[np.ndarray, ...], keys: np.ndarray, count: np.ndarray, first_of: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(uid, start, end) of the spans to remove in one chunk; keys are in order."""
    same, piece, doc, start, doc_ids, uids, origin = chunk
    piece, doc = np.cumsum(piece, dtype=np.int64), np.cumsum(doc, dtype=np.int64)
    start = np.cumsum(start, dtype=np.int64) - origin[doc]
    number = np.minimum(np.searchsorted(keys, same), len(keys) - 1)
    number[keys[number] != same] = -1
    runs = np.flatnonzero(number[piece] >= 0)
    k, owner = number[piece[runs]], doc_ids[doc[runs]]
    flat = _spread(first_of[k], count[k])
    gone = source[flat] < np.repeat(owner, count[k])
    run = np.repeat(np.arange(len(runs)), count[k])
    nth = _spread(np.zeros(len(runs), np.int64), count[k])
    joins = gone.copy()
    joins[:1] = False
    joins[1:] &= gone[:-1] & (run[1:] == run[:-1])
    head = np.flatnonzero(gone & ~joins)
    tail = np.flatnonzero(gone & ~np.append(joins[1:], False)[: len(gone)])
    lo = start[runs][run[head]] + nth[head]
    hi = start[runs][run[tail]] + nth[tail] + WIDTH
    return uids[doc[runs]][run[head]], lo, hi


def _by_part(uid: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc_parts: int) -> pd.DataFrame:
    part = uid.astype(np.uint64) % _U(doc_parts)
    order = np.lexsort((lo, uid, part))
    part, uid, lo, hi = part[order], uid[order], lo[order], hi[order]
    cuts = np.flatnonzero(np.diff(part, prepend=part[:1] + _U(1)))
    ends = np.append(cuts[1:], len(part))
    return pd.DataFrame(
        {"part": part[cuts].astype(np.int32), "blob": [_pack([(uid[a:b], lo[a:b], (hi - lo)[a:b].astype(np.int32))]) for a, b in zip(cuts, ends, strict=True)]}
    )


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > reach[:-1])
    return lo[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]


def _applied(docs: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    uid, lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(spans):
        uid, lo, size = (np.concatenate(x) for x in zip(*[part for b in spans.blob for part in _unpack(b)], strict=True))
        order = np.argsort(uid, kind="stable")
        uid, lo, hi = uid[order], lo[order], (lo + size)[order]
    out = []
    for doc_id, own, text in zip(docs.doc_id, docs.uid, docs.text, strict=True):
        raw = text.encode()
        a, b = np.searchsorted(uid, [own, own + 1]) if own < np.iinfo(np.int64).max else (np.searchsorted(uid, own), len(uid))
        starts, stops = _union(lo[a:b], hi[a:b]) if b > a else (lo[:0], hi[:0])
        pieces, at = [], 0
        for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
            pieces.append(raw[at:s])
            at = e
        rest = b"".join([*pieces, raw[at:]])
        spans_ = [{"start": s, "end": e} for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]
        out.append((doc_id, len(raw), len(raw) - len(rest), spans_, rest, hashlib.sha256(rest).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])


def masks_of(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, runs, blob): places and masks of each bucket, written."""
    pieces = texts.where(F.octet_length("text") >= WIDTH).mapInPandas(lambda it: _mapped(it, buckets), "bucket int, runs long, blob binary")
    return cut(pieces.groupBy("bucket").applyInPandas(_bucket, "bucket int, runs long, blob binary"))


def places_of(texts: DataFrame, buckets: int, salts: dict[int, int]) -> DataFrame:
    """(bucket, salt, blob): the places of pieces, by chunk of text."""
    return texts.where(F.octet_length("text") >= WIDTH).mapInPandas(lambda it: _mapped(it, buckets, salts), "bucket int, salt int, blob binary")


def remove_repeats(docs: DataFrame, keep_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) and, if asked for, the bytes kept.

    spans are the maximal runs of removed bytes. Null texts are empty, texts below WIDTH bytes
    keep all. Rows that share an id don't remove each other's bytes, so repeated rows end
    alike; null ids come after all others. Of equal texts the smallest id stays. An empty table
    gives no rows. Kept bytes may end within a character and so are binary.
    """
    spark = docs.sparkSession
    null_id = F.lit((1 << 63) - 1)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), null_id).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("uid", F.xxhash64("doc_id", "text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, math.ceil(size * 3.7 / BUCKET))
    doc_parts = max(8, math.ceil(size / BUCKET))

    masks = masks_of(texts, buckets)
    tasks = F.ceil(F.col("runs") / RUNS).cast("int")
    # at most one number for RUNS places
    salts = {r["bucket"]: r["n"] for r in masks.where(F.col("runs") > RUNS).select("bucket", tasks.alias("n")).collect()}
    dealt = masks.where("blob is not null").select("bucket", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("salt"), "blob")
    spans = cut(
        places_of(texts, buckets, salts)
        .groupBy("bucket", "salt")
        .cogroup(dealt.groupBy("bucket", "salt"))
        .applyInPandas(lambda places, masks: _masked(places, masks, doc_parts), "part int, blob binary")
    )
    # the unsigned remainder, as numpy takes it
    part = F.expr(f"cast(pmod(pmod(uid, {doc_parts}) + if(uid < 0, {(1 << 64) % doc_parts}, 0), {doc_parts}) as int)")
    done = (
        texts.withColumn("part", part)
        .groupBy("part")
        .cogroup(spans.groupBy("part"))
        .applyInPandas(_applied, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string")
    )
    done = done.withColumn("doc_id", F.when(F.col("doc_id") < null_id, F.col("doc_id")))
    return done if keep_text else done.drop("kept")


def op5(spark, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
