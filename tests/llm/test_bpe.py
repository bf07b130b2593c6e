"""Byte-level BPE against the library whose ranks it uses, and on odd input."""

import hashlib
import random

import pytest

from siltworks.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.BytePairs.load()


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def odd_texts():
    rng = random.Random(11)
    out = ["".join(rng.choice("aab the in  \n\t\x85 én中文字ab's123.,!?😀") for _ in range(rng.randint(1, 90))) for _ in range(3_000)]
    out += ["".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0xE000, 0x110000)])) for _ in range(20)) for _ in range(2_000)]
    out += ["x" * 9_000, " " * 5_000, "ab" * 20_000, "😀" * 3_000, "\n" * 7_777, "thethe" * 4_000, "\x00", "<|endoftext|> it's"]
    return out


def test_encodes_as_the_library(vocabulary, library):
    for text in odd_texts():
        ids = vocabulary.encode(text)
        assert ids == library.encode_ordinary(text), text[:80]
        assert vocabulary.decode(ids) == text.encode()


def test_characters_of_later_classes(vocabulary, library):
    for first, last in bpe.LATER:
        for c in (chr(first), chr(last)):
            text = f"a{c}1{c} {c}{c}!{c}a 2 {c}"
            assert vocabulary.encode(text) == library.encode_ordinary(text)


def test_ranks_that_fall_from_part_to_whole():
    """No order of ranks is assumed: a vocabulary with shuffled ranks gives what plain merging gives."""
    rng = random.Random(2)
    for _ in range(30):
        words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(25)}
        tokens = [bytes([b]) for b in range(256)] + sorted(words)
        rng.shuffle(tokens)
        ranks = {t: i for i, t in enumerate(tokens)}
        own = bpe.BytePairs(ranks, r"[\s\S]+")
        for _ in range(60):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            want = [ranks[data]] if data in ranks else [ranks[p] for p in bpe.merged(data, ranks)]
            assert own.encode(data.decode()) == want


def test_memory_of_results_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    table = bpe._Remembered(lambda k: k + 1)
    assert [table[k] for k in range(100)] == list(range(1, 101)) and len(table) <= 10


def test_a_byte_without_a_token_is_an_error():
    with pytest.raises(ValueError, match="no token"):
        bpe.BytePairs({b"a": 0}, r".+")


def test_rows(spark, library):
    rows = [(1, "Hello  world\n", "x"), (1, "Hello  world\n", "x"), (2, None, "x"), (3, "", None), (None, "a\tb", "x"), (4, "é" * 30_000, "x"), (5, "word " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode_documents(docs.repartition(3)).select("doc_id", "ids", bpe.decoded("ids").alias("back")).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"]), bytes(r["back"])) for r in got) == want
    assert bpe.encode_documents(docs.limit(0)).collect() == []
    assert spark.createDataFrame([(None,)], "ids array<int>").select(bpe.decoded("ids").alias("x")).first()["x"] is None


def test_op11(spark, tmp_path, library):
    texts = [(1, "it's 2 o'clock"), (2, None), (3, "ß" * 10)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = lambda t: library.encode_ordinary(t or "")
    want = [(i, len(ids(t)), sha(",".join(map(str, ids(t))).encode()), sha((t or "").encode())) for i, t in texts]
    assert sorted(map(tuple, bpe.op11(spark, str(tmp_path)).collect())) == want
