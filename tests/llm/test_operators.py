"""Corpus operators against brute force, and on nulls, ties, repeats, long and empty input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from siltworks.llm import common, embeddings, lines, minhash, mixing, pieces, quality, secrets, sharding, suffixes, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, copies int, _key string, kept string, score string, row int, _text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents (id, text[, source]) with more columns, of names that operators use themselves."""
    full = [(i, t, "en", s[0] if s else "a", len(t or ""), "x", 1, "k", "y", "z", 7, "t") for i, t, *s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(30)
    out = [(i, "\n".join(text(rng.randint(3, 25)) for _ in range(rng.randint(1, 5))), rng.choice(["a", "b", "é"])) for i in range(60)]
    for i in range(60, 90):
        base = out[rng.randrange(60)][1].split(" ")
        if i % 3:
            base[rng.randrange(len(base))] = "changed"
        out.append((i, " ".join(base), "a"))
    out += [(90 + i, f"{text(4)} {passage}\n{text(8)}", "b") for i in range(6)]
    out += [(100, None, None), (101, "", "a"), (102, " \n\t", None), (103, "one", "b"), (104, "One", "b")]
    out += [(110, text(3000), "b"), (111, "x" * 9000, "b"), (112, "x" * 9000, "a"), (None, "no id here at all", "a"), (5, out[5][1], out[5][2])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(4).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def words(text):
    return WORDS.findall(text or "")


def test_mixing(spark, docs, rows, nothing):
    got = mixing.mix_copies(docs, common.word_count(docs["text"])).collect()
    assert sum(r["rows"] for r in got) == len(rows) and all(0 <= r["copies"] <= 2 * r["rows"] for r in got)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight, open_, left, target = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, set(order), 1.5 * sum(sizes.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    taken, largest = Counter(), Counter()
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in order)
    again = mixing.mix_copies(docs.repartition(7), common.word_count(docs["text"])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix_documents(nothing).count() == 0


def test_different_vectors_of_one_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [-1.0, 0.0])]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_mixing_much_repeated_rows(spark):
    """A source of one row, a hundred times: what is taken misses the target by less than that row."""
    text = " ".join("w" * 3 for _ in range(10))
    docs = spark.createDataFrame([(1, text, "a", k % 3) for k in range(100)] + [(2, "x", "b", 0)], "doc_id long, text string, source string, extra int")
    got = {r["doc_id"]: r for r in mixing.mix_copies(docs, common.word_count(docs["text"])).collect()}
    assert abs(got[1]["copies"] * 10 - got[1]["target"]) <= 10 and got[1]["rows"] == 100
    mixed = mixing.mix_documents(docs).where("doc_id = 1")
    assert mixed.count() == got[1]["copies"]
    each = {r["extra"]: r["count"] for r in mixed.groupBy("extra").count().collect()}
    assert all(33 <= each[k] <= 68 for k in range(3))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mixing.mix_documents(docs.repartition(5)).where("doc_id = 1").collect()))


def test_mixing_is_unbiased(spark):
    import pandas as pd

    total = np.zeros(40)
    for seed in range(300):
        g = pd.DataFrame({"_key": range(40), "_mass": np.arange(1.0, 41), "_p": 0.3, "_rank": np.arange(40) * 1000 + seed})
        out = mixing._round_group(g).sort_values("_key")
        assert abs((out._p * out._mass).sum() - 0.3 * 820) < 1e-6 and ((out._p > 0) & (out._p < 1)).sum() <= 1
        total += out._p.to_numpy()
    assert abs(total / 300 - 0.3).max() < 0.12


def test_sharding(docs, rows, nothing):
    got = sharding.shard_by_bytes(docs, 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), None if t is None else zlib.crc32(t.encode())) for i, t, *_ in rows)
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["shard"], r["slot"])):
        by[r["shard"]].append(r)
    whole, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert all([r["slot"] for r in x] == list(range(len(x))) for x in by.values())
    assert all(abs(sum(r["size"] for r in x) - whole / 8) <= largest for x in by.values())
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for k in sorted(by) for r in by[k]]
    assert ids == sorted(ids)
    assert sharding.shard_by_bytes(nothing).count() == 0


def base_spans(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t or "", re.I | re.A):
        out += [(m.start(), "assign", m.end())] * (len(m[2]) >= 12)
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 18]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[1])))


def test_secrets(spark, nothing):
    key = "AKIA" + "Z9" * 8
    texts = [
        None, "", "é😀 password = 'abcdefghijkl'", "token=short api_key:secret=0123456789abcdef0", f"{key} AKIAAKIA{'B' * 12} AKIA12",
        "deadbeefdeadbeef" + "g" + "0" * 15, "SECRET=" + "a" * 12, "x" * 70_000 + " passwd:" + "9" * 20,
        f"AKIA{'Q1' * 5} far", f"password: abcdef1 AKIA{'Q1' * 5}", "password: abcdef1 https://h.example.org/x", "password: abcdef1" + " " * 300 + "https://h.example.org/x",
        "apikey=" + "token=" * 900 + "abcdefghijklmnop",
    ]
    df = frame(spark, list(enumerate(texts)) + [(2, texts[2])])
    got = secrets.scan_secrets(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == base_spans(texts[r["doc_id"]])
    linked = {r["doc_id"]: [s["kind"] for s in r["linked"]] for r in got}
    assert linked[8] == [] and linked[9] == ["weak_secret", "weak_id"] and linked[10] == ["weak_secret", "endpoint"] and linked[11] == []
    assert secrets.scan_secrets(nothing).count() == 0


def test_secrets_scope_lies_between_spans(spark):
    url, short = "https://h.example.org/?" + "q" * 227, "password: abcdef1"
    texts = [f"{url} {short}", f"{short} {url}", url + " " * 200 + short, url + " " * 201 + short, f"{url} AKIA{'Q1' * 5} token={'z' * 11}", "token=" + "a" * 300 + f" AKIA{'Q1' * 5}"]
    got = {r["doc_id"]: [s["kind"] for s in r["linked"]] for r in secrets.scan_secrets(frame(spark, list(enumerate(texts)))).collect()}
    assert got[0] == got[2] == ["endpoint", "weak_secret"] and got[1] == ["weak_secret", "endpoint"] and got[3] == []
    assert got[4] == ["endpoint", "weak_id", "weak_secret"] and got[5] == ["weak_id"]
    rng, rows_ = random.Random(6), []
    for row in range(300):
        spans = []
        for _ in range(rng.randint(1, 6)):
            rank, start = rng.randrange(6), rng.choice([rng.randrange(1500), 200 * rng.randrange(8)])
            spans.append((start, rank, start + rng.choice([1, 20, 200, rng.randint(1, 700)]), secrets.KINDS[rank]))
        rows_.append((row, sorted(s for s in spans if s[1] < 3), sorted(s for s in spans if s[1] >= 3)))
    secret = lambda s: secrets.ROLE[s[3]] == "secret"
    want = {}
    for row, base, weak in rows_:
        hit = {s for s in weak if any(secret(s) != secret(o) and max(s[0], o[0]) - min(s[2], o[2]) <= 200 for o in base + weak)}
        want |= {row: sorted(hit)} if hit else {}
    flat = [(row, *span) for row, base, weak in rows_ for span in base + weak]
    spans = spark.createDataFrame(flat, "_row long, start int, rank int, end int, kind string")
    got = defaultdict(list)
    for r in secrets.link_parts(spans).collect():
        got[r["_row"]].append((r["start"], r["rank"], r["end"], r["kind"]))
    assert {row: sorted(x) for row, x in got.items()} == want


def test_secrets_are_linear_in_their_number(spark):
    """One text of 60,000 spans of each of two kinds, with weak candidates that touch base spans."""
    text = "".join(f"token={'z' * 12} {'a' * 16} pass user=bob{k} " for k in range(60_000))
    (got,) = secrets.scan_secrets(frame(spark, [(1, text)])).collect()
    assert len(got["base"]) == 120_000 and len(got["linked"]) == 60_000
    assert [(s["start"], s["kind"], s["end"]) for s in got["base"]] == base_spans(text)


def shingles(t, n=5):
    w = words((t or "").translate(LOW))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def classes(n, linked):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


@pytest.mark.parametrize("block", [1_000, 3])
def test_minhash(docs, rows, nothing, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = [shingles(t) for _, t, *_ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    groups = classes(len(rows), pairs)
    least = {}
    for k, g in enumerate(groups):
        ids = [x for x in (least.get(g), rows[k][0]) if x is not None]
        least[g] = min(ids) if ids else None
    want = Counter((rows[k][0], len(sets[k]), least[g], rows[k][0] == least[g]) for k, g in enumerate(groups))
    got = minhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    if block == 1_000:
        kept = minhash.drop_near_duplicates(docs, 85)
        assert kept.columns == docs.columns
        first = {}
        for k, g in enumerate(groups):
            if sets[k]:
                first[g] = min(first.get(g, k), k, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, hashlib.sha1(rows[k][1].encode()).hexdigest(), k))
        stay = [rows[k][:2] for k, g in enumerate(groups) if not sets[k] or first[g] == k]
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(stay)
        assert minhash.near_duplicates(nothing).count() == 0


def test_minhash_keeps_other_texts_of_an_id(spark):
    """Rows are dropped as rows: a text of its own stays, though its id is also that of a copy."""
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    df = frame(spark, [(1, a), (2, a), (2, b), (None, a), (None, b), (1, a), (3, ""), (3, "")])
    got = minhash.drop_near_duplicates(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, a), (2, b), (3, ""), (3, "")]


def test_minhash_splits_groups_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 3_000)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(2_000)]
    texts = [" ".join("changed" if rng.random() < 0.003 else w for w in base) for _ in range(9)]
    got = minhash.near_duplicates(frame(spark, list(enumerate(texts))), 85).collect()
    sets = [shingles(t) for t in texts]
    want = classes(9, [(a, b) for a in range(9) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(want))


def test_minhash_first_common_coordinate_by_all_bits():
    import pandas as pd

    one = np.arange(minhash.K, dtype=">u4")
    two = one.copy()
    two[0] += 1 << 16
    rows_ = pd.DataFrame({"key": 1, "lo": 0, "hi": 0, "blk": 0, "place": 1, "cls": [b"a", b"b"], "sig": [one.tobytes(), two.tobytes()]})
    (got,) = minhash._collisions(iter([rows_]), 40)
    assert got.values.tolist() == [[b"b", b"a"]]


def test_lines(docs, rows, nothing):
    seen, want = [], defaultdict(set)
    order = sorted({(i, t) for i, t, *_ in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        for k, line in enumerate((t or "").split("\n")):
            own = set(words(line.lower()))
            if own:
                if not any(100 * len(own & s) >= 80 * len(own | s) for s in seen):
                    want[i].add(k)
                seen.append(own)
    got = {r["doc_id"]: r["kept"] for r in lines.kept_lines(docs).collect()}
    assert got == {i: sorted(k) for i, k in want.items()}
    out = lines.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert text[100] == (None, None) and text[101] == ("", 0) and text[102][0] == " \n\t" and text[104] == ("", 0)
    assert lines.drop_repeated_lines(nothing).count() == 0


def test_lines_of_few_words(spark):
    """Many lines right at the threshold, of every length, from few words."""
    rng, seen, want = random.Random(7), [], defaultdict(list)
    vocabulary = [f"w{k}" for k in range(25)]
    rows_ = []
    for i in range(60):
        lines_ = [" ".join(rng.sample(vocabulary, rng.choice([1, 2, 4, 5, 6, 9, 10, 11, 18, 20]))) for _ in range(8)]
        rows_.append((i, "\n".join(lines_)))
        for k, line in enumerate(lines_):
            own = set(line.split())
            if not any(100 * len(own & s) >= 80 * len(own | s) for s in seen):
                want[i].append(k)
            seen.append(own)
    got = {r["doc_id"]: r["kept"] for r in lines.kept_lines(frame(spark, rows_)).collect()}
    assert got == dict(want) and sum(map(len, want.values())) < 470


def test_lines_meet_in_short_lists_and_in_long_ones(spark, monkeypatch):
    """Variants of a few lines: only words counted often go by leaders, and either way keeps the same."""
    rng, seen, want = random.Random(9), [], defaultdict(list)
    bases = [[f"b{b}w{k}" for k in range(20)] for b in range(6)]
    rows_ = [(i, "\n".join(" ".join(w if rng.random() > 0.08 else f"x{rng.randrange(40)}" for w in rng.choice(bases)) for _ in range(5))) for i in range(50)]
    for i, text in rows_:
        for k, line in enumerate(text.split("\n")):
            own = set(line.split())
            if not any(100 * len(own & s) >= 80 * len(own | s) for s in seen):
                want[i].append(k)
            seen.append(own)
    docs = frame(spark, rows_)
    # no word has more than 250 places, so no list is long
    assert lines.posting_lists(lines.line_classes(docs, 80, "doc_id", "text"), 80).count() == 0
    for short in (lines.SHORT, 24, 0):
        monkeypatch.setattr(lines, "SHORT", short)
        assert {r["doc_id"]: r["kept"] for r in lines.kept_lines(docs).collect()} == dict(want), short
    assert lines.posting_lists(lines.line_classes(docs, 80, "doc_id", "text"), 80).count() > 0


def test_variants_of_a_line_make_no_square(spark, monkeypatch):
    """Variants that a leader settles meet no others, so the pairs follow the number of lines."""
    met, meetings = [], lines._meetings
    monkeypatch.setattr(lines, "_meetings", lambda *a: met.append(pairs := meetings(*a)) or pairs)
    base = [f"b{k}" for k in range(40)]
    for n in (400, 800):
        rows_ = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(n)]
        got = lines.kept_lines(frame(spark, rows_)).collect()
        assert [(r["doc_id"], r["kept"]) for r in got] == [(0, [0])]
        assert sum(pairs.count() for pairs in met) <= n
        met.clear()


def test_rarity_of_words(spark):
    """Each bucket's rank is that of its count, in order of the buckets; no row is made for a bucket without words."""
    docs = frame(spark, [(i, "\n".join(f"W{k}\tw{k} " * (1 + k % 7) + "\r" for k in range(i, i + 90)) + "end\nline") for i in range(40)])
    counts = Counter(w.lower() for (t,) in docs.select("text").collect() for w in words(t))
    bucket = {r["w"]: r["b"] for r in spark.createDataFrame([(w,) for w in counts], "w string").selectExpr("w", f"xxhash64(w) & {lines.SKETCH - 1} AS b").collect()}
    totals = Counter()
    for w, n in counts.items():
        totals[bucket[w]] += n
    table = lines.rarity_table(docs, "text")
    assert "Range (0, 4194304" not in table._jdf.queryExecution().toString()
    got = np.array(table.first()["rarity"])
    assert len(got) == lines.SKETCH and {b: int(got[b]) for b in np.flatnonzero(got)} == {b: min(127, int(4 * np.log2(n))) for b, n in totals.items() if n > 1}


def test_suffixes(docs, rows, nothing):
    seen, want = {}, Counter()
    ids = sorted({i for i, *_ in rows if i is not None}) + [None]
    for i in ids:
        new = set()
        for j, t, *_ in rows:
            if j != i:
                continue
            raw = (t or "").encode()
            gone = bytearray(len(raw))
            for k in range(len(raw) - 49):
                new.add(raw[k : k + 50])
                if raw[k : k + 50] in seen:
                    gone[k : k + 50] = b"\1" * 50
            kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
            runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
            want[(i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
        seen |= dict.fromkeys(new)
    got = suffixes.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got) == want
    assert suffixes.remove_repeats(nothing).count() == 0


def test_suffixes_deal_a_hot_bucket_to_many_tasks(spark, monkeypatch):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(400)
    rows_ = [(i, text(60) + passage + text(60)) for i in range(640)]
    df = frame(spark, rows_).repartition(32)
    whole = sorted(map(str, suffixes.remove_repeats(df).collect()))
    monkeypatch.setattr(suffixes, "RUNS", 200)
    assert sorted(map(str, suffixes.remove_repeats(df).collect())) == whole
    assert sum(len(passage) <= r["n_removed"] <= len(passage) + 12 for r in suffixes.remove_repeats(df).collect()) == 639
    texts = df.selectExpr("doc_id", "text", "xxhash64(doc_id, text) as uid")
    sizes = {r["bucket"]: r["runs"] for r in suffixes.masks_of(texts, 4).collect()}
    salts = {b: -(-n // 200) for b, n in sizes.items()}
    held = Counter()
    for r in suffixes.places_of(texts, 4, salts).collect():
        held[r["bucket"], r["salt"]] += sum(len(part[1]) for part in suffixes._unpack(r["blob"]))
    assert sum(held.values()) == sum(sizes.values()) and min(sizes.values()) > 1000
    for b, n in sizes.items():
        assert max(v for (c, _), v in held.items() if c == b) < n / 2


def test_suffix_order():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab\0") for _ in range(rng.randint(1, 30))).encode() for _ in range(40)]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    string, start, lcp = suffixes.suffix_order(flat, np.array([len(t) for t in texts]))
    # a zero byte sorts as the largest symbol
    got = [texts[s][p:] for s, p in zip(string, start, strict=True)]
    key = lambda t: t.replace(b"\0", b"\xff")
    assert [key(t) for t in got] == sorted(key(t[p:]) for t in texts for p in range(len(t)))
    for k in range(1, len(got)):
        common_ = next((n for n, (x, y) in enumerate(zip(got[k - 1], got[k], strict=False)) if x != y), min(len(got[k - 1]), len(got[k])))
        assert lcp[k] == common_


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    rng = random.Random(3)
    body = "".join(rng.choice("abcdef") for _ in range(2000))
    rows_ = [(1, "q" * 40 + body), (2, body[700:1500] + "zz"), (3, "k" * 299 + body[10:70])]
    got = {r["doc_id"]: r["n_removed"] for r in suffixes.remove_repeats(frame(spark, rows_).coalesce(1)).collect()}
    assert got[1] == 0 and got[2] == 800 and got[3] >= 60


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((120, 8))
    x[60:80] = x[:20] + 0.05 * rng.standard_normal((20, 8))
    x[80:90] = x[0]
    x[90:95] = 3 * x[1]
    out = [(k, v.astype(np.float32).astype(float).tolist(), "c") for k, v in enumerate(x)]
    out += [(120, None, "c"), (121, [0.0] * 8, "c"), (122, [float("nan")] + [1.0] * 7, "c"), (123, [None] + [1.0] * 7, "c"), (124, [], "c"), (125, [1.0, 2.0], "c")]
    return spark.createDataFrame([*out, out[5]], "vec_id long, embedding array<float>, cls string"), [*out, out[5]]


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [1_000, 4])
def test_embeddings(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    df, raw = vectors
    pairs, links = [], Counter()
    for a, (_, v, _) in enumerate(raw):
        for b, (_, w, _) in enumerate(raw[:a]):
            if usable(v) and usable(w) and len(v) == len(w) and any(v) and any(w):
                v_, w_ = np.array(v, float), np.array(w, float)
                if v_ @ w_ / np.sqrt(v_ @ v_) / np.sqrt(w_ @ w_) >= 0.95:
                    pairs.append((a, b))
                    links[a] += 1
                    links[b] += 1
    groups = classes(len(raw), pairs)
    least = {g: min(raw[k][0] for k in range(len(raw)) if groups[k] == g) for g in groups}
    want = Counter((raw[k][0], links[k], least[g], raw[k][0] == least[g]) for k, g in enumerate(groups))
    rows_ = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(df).collect()]
    most = {w[0]: w for w in want}
    # no link that isn't one: neither a greater count nor a component that brute force keeps apart
    assert len(rows_) == len(raw) and all(r[1] <= most[r[0]][1] and most[r[2]][2] == most[r[0]][2] and r[3] == (r[0] == r[2]) for r in rows_)
    assert sum(r[1] for r in rows_) >= 0.98 * sum(links.values()) > 0
    if block == 1_000:
        assert embeddings.near_vectors(df.limit(0)).count() == 0


def brute_top_k(rows_, every, k=5):
    want = set()
    for q, v in rows_:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows_ if i != q and len(w) == len(v))[:k]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return want


def test_top_k(spark, vectors, monkeypatch):
    df, raw = vectors
    monkeypatch.setattr(topk, "RUN", 4)
    monkeypatch.setattr(topk, "CHUNK", 2)
    rows_ = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in raw if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), block=4)
    assert Counter(map(tuple, got.collect())) == Counter(brute_top_k(rows_, 20))
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_beyond_exact_doubles(spark):
    """Products beyond 2 ** 53 and, with the last vectors, sums beyond long."""
    rng = np.random.default_rng(8)
    big = rng.integers(-(2**30), 2**30, (40, 3))
    whole = [[94906267, 1, 0], [94906267, 2, 0]] + big.tolist()
    for more in ([], [[2**40, 2**40, 2**40], [2**41, -(2**40), 2**39]]):
        rows_ = list(enumerate(whole + more))
        df = spark.createDataFrame([(i, [x / 256 for x in v]) for i, v in rows_], "vec_id long, embedding array<double>")
        ends = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        want = set()
        for q, v in rows_:
            best = sorted((-ends(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in rows_ if i != q)[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
        assert {tuple(r) for r in topk.top_k(df, df, block=4).collect()} == want


def test_top_k_leaves_blocks_out(spark, monkeypatch):
    """Alike vectors lie in few blocks: queries skip most runs, and blocks of the runs they see."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 16)) * 4
    x = (centres[rng.integers(0, 20, 2000)] + 0.02 * rng.standard_normal((2000, 16))).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(topk, "RUN", 4)
    queries = df.where("vec_id % 50 = 0")
    index = topk.index_of(df, queries, 5, 16)
    runs, asks = index.where("ask < 0").select("run").distinct().count(), index.where("ask >= 0").count()
    assert runs >= 30 and asks == 40 and topk.needed_runs(index).count() < 0.25 * runs * asks
    rows_ = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in enumerate(x.tolist())]
    assert {tuple(r) for r in topk.top_k(df, queries, block=16).collect()} == brute_top_k(rows_, 50)
    docs = np.floor(256 * x[np.argsort(x @ rng.standard_normal(16))]).astype(np.int64)
    cuts = np.arange(0, 2000, 16)
    top, low = np.maximum.reduceat(docs, cuts), np.minimum.reduceat(docs, cuts)
    score, ids, scored = topk.best_of_block_order(docs[7], 7, docs, np.arange(2000), top, low, 5, 16)
    assert scored < 0.5 * len(cuts) and sorted(score.tolist()) == sorted(np.delete(docs @ docs[7], 7))[-5:]


def brute_segmentations(v, s, n):
    out = []

    def go(p, g, ids):
        if p == len(s):
            out.append((g, ids))
            return
        for e in range(p + 1, len(s) + 1):
            if found := v.pieces.get(s[p:e]):
                go(e, g + found[1], ids + [found[0]])
            elif e == p + 1:
                go(e, g + v.fallback, ids + v.fall_back(s[p:e]))

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])[:n]


def test_pieces(spark, docs, rows, nothing):
    v = pieces.vocabulary(None)
    for text in ["hello wor", "a\nb", "  two", "▁x 漢字", "", "über 12"]:
        (ids, score, more), = pieces.encode_texts(v, [text], 4)
        if text:
            assert [score] + [m["score"] for m in more] == [g for g, _ in brute_segmentations(v, " " + text, 4)]
        for m in more:
            full = ids.tolist()
            for e in sorted(m["edits"], key=lambda e: -e["at"]):
                full[e["at"] : e["at"] + e["drop"]] = e["ids"]
            assert v.decode(full) == text
    many = [w for _, t, *_ in rows for w in (t or "").split()] + ["漢é"]
    flat, offsets, scores, gaps = v.solve([" " + w for w in many])
    for k in range(0, len(many), 37):
        best, back, gap = v.forward(" " + many[k])
        assert (best[-1], gap) == (scores[k], gaps[k]) and flat[offsets[k] : offsets[k + 1]].tolist() == v.spell(" " + many[k], back)
    encoded = pieces.encode_documents(docs)
    got = encoded.collect()
    assert len(got) == len(rows) and all(r["round_trip"] or r["ids"] is None for r in got)
    decoded = pieces.decode_documents(encoded)
    assert Counter((r["doc_id"], r["text"]) for r in decoded.collect()) == Counter((i, t) for i, t, *_ in rows)
    assert pieces.encode_documents(nothing).count() == 0


def test_quality(spark, nothing):
    rng = random.Random(9)
    plain = lambda: " ".join(rng.choice(["river", "stone", "walks", "under", "light", "green", "hills"]) for _ in range(30)).capitalize() + "."
    shout = lambda: "!! ".join(rng.choice(["BUY", "NOW", "CLICK", "FREE"]) for _ in range(30))
    texts = [plain() if k % 3 else shout() for k in range(300)]
    rows_ = [(k, t) for k, t in enumerate(texts)] + [(500, None), (501, ""), (0, texts[0])]
    df = frame(spark, rows_)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(150)] + [(None, 1), (7, None)], "doc_id long, quality int")
    got = quality.score_documents(df, labels, ["doc_id"]).collect()
    assert len(got) == len(rows_)
    unseen = [r for r in got if 150 <= r["doc_id"] < 300]
    assert sum(r["kept"] == (r["doc_id"] % 3 > 0) for r in unseen) >= 0.97 * len(unseen)
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality.score_documents(nothing, labels).count() == 0
    assert {r["score"] for r in quality.score_documents(df, labels.limit(0), ["doc_id"]).collect()} == {1.0}


def test_quality_takes_from_all_unlabelled(spark, monkeypatch):
    n = 6_000
    bad = lambda k: k % 3 == 0
    df = frame(spark, [(k, f"BUY NOW!! {k % 7} FREE!!" if bad(k) else f"the river walks {k % 7} under stones") for k in range(n)])
    labels = spark.createDataFrame([(k, int(not bad(k))) for k in range(300)], "doc_id long, quality int")
    fits, fit = [], quality._fit
    monkeypatch.setattr(quality, "_fit", lambda rows, view, *a, **k: fits.append((view, rows.count(), rows.select("doc_id").distinct().count())) or fit(rows, view, *a, **k))
    quality.co_train(df, labels, "doc_id", "text", "source", "lang")
    give = int((n - 300) * quality.CONFIDENT)
    for view in ("content", "page"):
        sizes = [rows for v, rows, _ in fits if v == view]
        assert [x - sizes[0] for x in sizes] == pytest.approx([0, give, 2 * give], abs=2)
    assert all(rows == ids for _, rows, ids in fits)


def test_quality_looks_up_by_shuffle_alike(spark, monkeypatch):
    rng = random.Random(4)
    words = {y: [f"{'ab'[y]}{k:02d}" for k in range(40)] for y in (0, 1)}
    df = frame(spark, [(k, " ".join(rng.sample(words[k % 2], 8)), f"site{k % 7}") for k in range(400)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, quality int")
    kept = lambda: sorted((r["doc_id"], r["kept"]) for r in quality.score_documents(df, labels, ["doc_id"]).collect())
    before = kept()
    monkeypatch.setattr(quality, "LOOKED_UP", 10)
    assert kept() == before


def test_quality_exchange_teaches_both_views(spark):
    """Few labels, many words and sources: co-training beats each view, and both together, without it."""
    rng = random.Random(12)
    own = {y: [f"{'ab'[y]}{k:03d}" for k in range(300)] for y in (0, 1)}
    either = [f"c{k:03d}" for k in range(200)]
    truth = {k: rng.randrange(2) for k in range(3_000)}
    text = lambda y: " ".join(rng.sample(own[y], 6) + rng.sample(either, 6))
    df = frame(spark, [(k, text(y), f"site{2 * rng.randrange(15) + y}") for k, y in truth.items()])
    labels = spark.createDataFrame([(k, truth[k]) for k in range(60)], "doc_id long, quality int")
    right = lambda rows, column: sum((r[column] >= 0.5) == truth[r["doc_id"]] for r in rows if r["doc_id"] >= 60) / 2_940
    alone = quality.score_documents(df, labels, ["doc_id"], rounds=1).collect()
    taught = quality.score_documents(df, labels, ["doc_id"]).collect()
    before = {c: right(alone, c) for c in ("p_content", "p_page", "score")}
    assert right(taught, "score") > max(before.values()) + 0.02, (before, right(taught, "score"))
    assert right(taught, "p_content") > before["p_content"] and right(taught, "p_page") > before["p_page"]


def test_quality_fit_by_hand(spark):
    """A view's fit against Newton's method on the same penalised likelihood."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 3)) * [1.0, 2.0, 0.5]
    y = (rng.random(200) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 2.0] + 0.3)))).astype(float)
    rows_ = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["page", "label"])
    model = quality._fit(rows_, "page", reg=0.01)
    design, w = np.hstack([x, np.ones((200, 1))]), np.zeros(4)
    penalty = 0.01 * np.append(x.std(axis=0, ddof=1) ** 2, 0)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        slope, bend = design.T @ (p - y) / 200 + penalty * w, (design.T * (p * (1 - p))) @ design / 200 + np.diag(penalty)
        w -= np.linalg.solve(bend, slope)
    assert np.allclose([*model.coefficients, model.intercept], w, atol=2e-3)


def test_quality_rejects_toxic(spark):
    rng = random.Random(2)
    plain = lambda: " ".join(rng.choice(["river", "stone", "walks", "under", "light", "green", "hills"]) for _ in range(30))
    df = frame(spark, [(k, plain() + (" idiot scum" if k % 3 == 0 else "")) for k in range(300)])
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0) if k % 5 else (None if k % 3 else 1)) for k in range(150)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(df, labels, ["doc_id"]).collect()
    assert sum(r["kept"] == (r["doc_id"] % 3 > 0) for r in got if r["doc_id"] >= 150) >= 145


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[k] == 0 for k in range(41)) and got[200] == got[150] == 100


def test_only_windows_that_other_pieces_may_have_are_ordered(monkeypatch):
    """Sides of pieces that no other piece has stay out of the order, and masks are those of brute force."""
    rng = random.Random(3)
    some = lambda n: "".join(rng.choices("abcdefgh", k=n))
    copied, shared = some(900), [some(rng.randint(55, 140)) for _ in range(8)]
    texts = [copied, copied, *("".join(some(rng.randint(0, 40)) + rng.choice(shared) for _ in range(6)) for _ in range(25)), copied]
    ids = rng.sample(range(1_000), len(texts))
    docs = pd.DataFrame({"doc_id": ids, "uid": ids, "text": texts})
    order, sizes = suffixes.suffix_order, []
    monkeypatch.setattr(suffixes, "suffix_order", lambda text, lengths: sizes.append(len(text)) or order(text, lengths))
    made = suffixes._bucket(next(suffixes._mapped(iter([docs]), 1)))
    where = defaultdict(set)
    for k, t in zip(ids, texts, strict=True):
        for s in range(len(t) - suffixes.WIDTH + 1):
            where[t[s : s + suffixes.WIDTH]].add(k)
    gone = Counter()
    spans = suffixes._masked(next(suffixes._mapped(iter([docs]), 1, {})), made, 1)
    for uid, lo, size in (part for b in spans.blob for part in suffixes._unpack(b)):
        for u, a, n in zip(uid.tolist(), lo.tolist(), size.tolist(), strict=True):
            gone.update((u, at) for at in range(a, a + n))
    want = {(k, s + i) for k, t in zip(ids, texts, strict=True) for s in range(len(t) - suffixes.WIDTH + 1) if min(where[t[s : s + suffixes.WIDTH]]) < k for i in range(suffixes.WIDTH)}
    assert set(gone) == want
    # copies alone have nothing to be put in order with
    sizes.clear()
    alone = suffixes._bucket(next(suffixes._mapped(iter([docs[docs.text == copied]]), 1)))
    assert len(alone.blob[0]) and not sizes


def test_a_chunk_of_text_takes_little_memory():
    """Workers of one executor map chunks side by side: about 56 bytes of arrays for each byte of text."""
    import tracemalloc

    text = random.Random(1).randbytes(1 << 19).translate(bytes(97 + k % 20 for k in range(256)))
    one = np.zeros(1, np.int64)
    tracemalloc.start()
    made = sum(n for _, n, _ in suffixes._pieces([text], one, one, one, 8, None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made and peak < 60 * len(text)
