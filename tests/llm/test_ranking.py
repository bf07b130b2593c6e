"""Ranked search against plain scoring, the bitmap arithmetic, and odd input."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siltworks.llm import ranking

TERM = re.compile(ranking.TERM)
LOW = str.maketrans(ranking.UPPER, ranking.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def plain_search(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every row of items."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms, df = len(bags), sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            slow = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * slow)) for t in set(terms(text)) if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10, parts=3, **index):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, term string").repartition(parts)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    n_docs, n_terms = ranking.collection(d)
    got = ranking.search(ranking.build_index(d, n_docs, n_terms, **index), n_docs, q, k)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé1") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(200)]
    docs += [(300 + i, docs[7][1]) for i in range(40)] + [(5, docs[5][1])] + [(5, text(9)), (None, docs[7][1]), (None, "une fois")]
    docs += [(400, None), (401, ""), (402, "--\x00--"), (403, text(9_000)), (404, "z" * 5_000), (2**62, "rare"), (-5, "rare")]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "absent_from_all"), (53, docs[7][1].upper()), (54, "RARE rare"), (54, "une"), (None, "z" * 5_000)]
    return docs, items


def test_search_equals_plain_scoring(spark, corpus):
    docs, items = corpus
    want = plain_search(docs, items)
    assert searched(spark, docs, items) == want
    assert searched(spark, docs, items, block=64, parts=2) == want


def test_search_in_chunks_and_by_shuffles(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(ranking, "ITEMS", 3)
    monkeypatch.setattr(ranking, "LOOKED_UP", 0)
    monkeypatch.setattr(ranking, "KEPT", 1)
    assert searched(spark, docs, items, k=3, block=100) == plain_search(docs, items, k=3)


def test_nothing(spark, corpus):
    docs, items = corpus
    assert searched(spark, [], items) == []
    assert searched(spark, [(1, None), (2, "  ")], items) == []
    assert searched(spark, docs, []) == []


def test_sums_and_products_of_bitmaps():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 20, (40, 128))
    planes = [ranking.spread(np.arange(128).astype("<u2").tobytes(), ranking.sliced(v[None]).tobytes(), 128, 2) for v in values]
    read = lambda x: (np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").astype(np.int64) << np.arange(len(x))[:, None]).sum(axis=0)
    assert (read(planes[0]) == values[0]).all()
    for n in (1, 2, 3, 7, 40):
        assert (read(ranking.add(planes[:n], 27)) == values[:n].sum(axis=0)).all()
    for weight in (1, 2, 13, 24_999):
        assert (read(ranking.times(planes[3], weight)) == values[3] * weight).all()


def test_best_breaks_ties_by_order():
    rng = np.random.default_rng(2)
    for _ in range(100):
        values, order = rng.integers(0, 6, 64), rng.permutation(64)
        number = ranking.spread(np.arange(64).astype("<u2").tobytes(), ranking.sliced(values[None]).tobytes(), 64, 1)
        at, score = ranking.best(number, 10, order)
        want = sorted((-v, o, p) for p, (v, o) in enumerate(zip(values, order, strict=True)) if v)[:10]
        assert sorted(zip(at, score, strict=True)) == sorted((p, -v) for v, _, p in want)


def test_index_has_every_document_and_term(spark, corpus):
    docs, _ = corpus
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    index = ranking.build_index(d, *ranking.collection(d), block=50)
    assert index.where("term is null").groupBy().sum("n").first()[0] == len(docs)
    df = Counter(t for _, text in docs for t in set(terms(text)))
    assert {r["term"]: r["n"] for r in index.where("term is not null").groupBy("term").sum("n").withColumnRenamed("sum(n)", "n").collect()} == df
