"""Byte-level BPE encoding in linear time, and decoding.

Text is split by the tokenizer's pattern, and each match is encoded by itself. Its bytes stand as
Latin-1 characters in an Aho-Corasick automaton of the vocabulary, which finds every token that
occurs; the longest one from each place is tried first, then its shorter prefixes. Two tokens are
compatible if merging their joined bytes by rank gives these two again. A row of tokens is what the
merges give exactly if all neighbours in it are compatible: the first merge across a border would
also happen among its two neighbours alone. The prefix up to a place has one encoding at most,
so a place from which no token leads on is dead for good, and each place is left at most once.

Compatibility is remembered by pair, short matches are remembered whole, both in tables of bounded
size. Nothing is assumed about ranks: they may fall from part to whole, and tokens that no merge
reaches are only used where a whole match is such a token, as the merges' own library does.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Entries of a table of remembered results, which is emptied when full.
REMEMBERED = 1 << 18
#: Bytes of a match that is remembered whole.
SHORT = 64
#: Behind every rank.
NEVER = 1 << 62
ROWS = 256

#: First and last code points of ranges that became letters or numbers after Unicode 16,
#: by whose classes tokens were split.
LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


def merged(data: bytes, ranks: dict[bytes, int], keep: int = 1) -> list[bytes]:
    """The parts that merging by rank leaves, or `keep` of them: lowest rank first, leftmost of equals. For few bytes."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > keep:
        found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


#: Neither letter, number nor white space, now or later.
UNASSIGNED = "\U0010ffff"


class _Remembered(dict):
    def __init__(self, make, keep=lambda key: True):
        super().__init__()
        self.make, self.keep = make, keep

    def __missing__(self, key):
        value = self.make(key)
        if self.keep(key):
            if len(self) >= REMEMBERED:
                self.clear()
            self[key] = value
        return value


def ranks_of(path: str | None = None) -> dict[bytes, int]:
    """From a file of ranks, one base64 token and its rank a line."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS)
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def tokens_of(path: str | None = None) -> dict[int, bytes]:
    """The bytes of every id: all that decoding needs."""
    return {rank: token for token, rank in ranks_of(path).items()}


class _LaterCharacter(Exception):
    """A match holds a character of LATER, so the text was not split as it should be."""


class BytePairs:
    """A vocabulary of byte strings with ranks, which are their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for {len(missing)} of 256 bytes")
        self.ranks, self.bytes_of = ranks, {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.split = self.pattern.findall
        self.later = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER) + "]")
        self.size, self.most = {i: len(t) for t, i in ranks.items()}, max(map(len, ranks))
        self.automaton = ahocorasick.Automaton()
        #: By each prefix of a token, the longest token that it begins with.
        self.begins = {}
        #: The longest token that is a shorter prefix of a token; -1 for none.
        self.shorter = {}
        for t, i in sorted(ranks.items()):
            chars = t.decode("latin-1")
            self.automaton.add_word(chars, i)
            self.shorter[i] = -1
            for k in range(1, len(chars) + 1):
                self.begins[chars[:k]] = ranks.get(t[:k], self.begins.get(chars[: k - 1]))
                if k < len(chars):
                    self.shorter[i] = self.begins[chars[:k]]
        self.automaton.make_automaton()
        self.trees = _Remembered(self._tree)
        self.compatible = _Remembered(self._compatible)
        self.known = _Remembered(self.encode_match, lambda match: len(match) <= SHORT)

    @classmethod
    @lru_cache(maxsize=4)
    def load(cls, path: str | None = None, pattern: str | None = None) -> BytePairs:
        """From a file of ranks; the public multilingual vocabulary and its pattern by default."""
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        return cls(ranks_of(path), pattern)

    def _tree(self, token: int) -> tuple[tuple[int, ...], tuple[int, ...]] | None:
        """Spines of a token's merges, from byte to whole: the first parts and the last parts.

        None where merges of its bytes give something else, or where a part has a higher rank
        than what it is merged into, so that merges don't run in order of rank.
        """
        parts = merged(self.bytes_of[token], self.ranks, keep=2)
        if len(parts) == 1:
            return (token,), (token,)
        if len(parts) != 2 or b"".join(parts) not in self.ranks:
            return None
        left, right = (self.ranks[p] for p in parts)
        first, last = self.trees[left], self.trees[right]
        if first is None or last is None or max(left, right) > token:
            return None
        return (*first[0], token), (*last[1], token)

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merges of both tokens' bytes give the two again.

        In order of rank, the part before the border and the part behind it grow along their
        spines; the two don't stay apart if their own merge comes before the next one on
        either side. Of equal ranks the left one is first.
        """
        a, b = self.trees[pair[0]], self.trees[pair[1]]
        bytes_of, ranks = self.bytes_of, self.ranks
        if a is None or b is None:
            return merged(bytes_of[pair[0]] + bytes_of[pair[1]], ranks) == [bytes_of[pair[0]], bytes_of[pair[1]]]
        left, right, i, j = (*a[1], NEVER), (*b[0], NEVER), 0, 0
        while True:
            across = ranks.get(bytes_of[left[i]] + bytes_of[right[j]], NEVER)
            if across < left[i + 1] and across <= right[j + 1]:
                return False
            if left[i + 1] == right[j + 1] == NEVER:
                return True
            if left[i + 1] <= right[j + 1]:
                i += 1
            else:
                j += 1

    def _alone(self, token: int) -> bool:
        """Whether merges make this token of its bytes."""
        return self.trees[token] is not None or merged(self.bytes_of[token], self.ranks) == [self.bytes_of[token]]

    def encode_match(self, match: str) -> list[int]:
        """Ids of one match of the pattern."""
        if not match.isascii() and self.later.search(match):
            raise _LaterCharacter
        return self.encode_bytes(match.encode())

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of the bytes of a match, by backtracking from the longest tokens if they are no token themselves."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        chars, n, most = data.decode("latin-1"), len(data), self.most
        size, shorter, compatible, begins, reach = self.size, self.shorter, self.compatible, self.begins, self.automaton.longest_prefix
        out, at, dead, last = [], 0, set(), -1
        rest = chars[:most]
        token = begins[rest[: reach(rest)]] if n else -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if (compatible[last, token] if last >= 0 else self._alone(token)) and end not in dead:
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                if at < n:
                    rest = chars[at : at + most]
                    token = begins[rest[: reach(rest)]]
            else:
                # nothing leads on from here: take the last token back and try a shorter one
                dead.add(at)
                at -= size[last]
                out.pop()
                token, last = shorter[last], out[-1] if out else -1
        return out

    def encode(self, text: str) -> list[int]:
        try:
            return list(chain.from_iterable(map(self.known.__getitem__, self.split(text))))
        except _LaterCharacter:
            # split it with characters in their place that are neither letters nor numbers
            plain = self.later.sub(UNASSIGNED, text)
            return [i for m in self.pattern.finditer(plain) for i in self.encode_bytes(text[m.start() : m.end()].encode())]

    def decode(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, ids): token ids of every row's whole text, as an array of int.

    Null and empty texts give an empty array; repeated rows and ids are encoded each on its own,
    null ids stay, other columns are not read. The path to the vocabulary is one that every
    executor can read. Rows go through in batches of ROWS; a task holds one batch and its tables
    of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = BytePairs.load(path, pattern)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                ids = [vocabulary.encode(t) if t else [] for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decoded(ids: Column | str, path: str | None = None) -> Column:
    """The bytes that an array of token ids stands for; null for null. An id that is no token's is an error."""

    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        tokens = tokens_of(path)
        return rows.map(lambda x: None if x is None else b"".join([tokens[i] for i in x.tolist()]))

    return run(ids)


def op11(spark, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2(decoded("ids"), 256).alias("decoded_sha256"),
    )
