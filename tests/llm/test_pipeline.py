import random
from collections import Counter

import corpus_pipeline
from siltworks.llm import minhash

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "minhash_near_dedup":
            assert minhash.near_duplicates(docs, 80).where("not kept").count() == 0
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    assert docs.where("not round_trip").count() == 0
    assert counts[4] == counts[5]


def test_each_stage_takes_what_is_planted_for_it(spark, tmp_path):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    junk = lambda: "!!! ".join(rng.choice(["BUY", "NOW", "CLICK", "FREE", "$$$"]) for _ in range(40))
    rows = [(k, junk() + str(k) if k % 4 == 0 else "\n".join(prose(20) for _ in range(4))) for k in range(400)]
    good = {k: t for k, t in rows if k % 4}
    copies = [(1000 + k, good[k]) for k in list(good)[:20]]
    # the words of a document in lines broken elsewhere: no line is like one before, all shingles are
    broken = [(2000 + k, "\n".join(" ".join(w) for w in (t.split()[:33], t.split()[33:]))) for k, t in list(good.items())[40:60]]
    odd = [(3000, None), (3001, ""), (3002, " \n "), (3003, "one")]
    every = [(k, t, "en", "abc"[k % 3], len(t or "")) for k, t in rows + copies + broken + odd]
    spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "sf" / "labels.parquet"))
    docs, left = spark.createDataFrame(every, COLUMNS), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path / "sf")).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    junk_ids = {k for k, _ in rows if k % 4 == 0}
    kept = left["quality_classifier"]
    assert not junk_ids & set(kept) and len(set(good) & set(kept)) >= 0.98 * len(good)
    lines = left["line_dedup"]
    assert not {k for k, _ in copies} & set(lines) and set(good) & set(kept) == set(good) & set(lines)
    near = left["minhash_near_dedup"]
    assert {k for k, _ in broken} & set(lines) and not {k for k, _ in broken} & set(near) and set(good) & set(lines) == set(good) & set(near)
    assert max(left["source_mixing"].values()) <= 2 and left["source_mixing"] == left["piece_encoding"]


def test_stages_on_nothing(spark, tmp_path):
    """An empty table passes through all stages, and so do columns that stages use themselves."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "sf" / "labels.parquet"))
    columns = COLUMNS + ", _row string, _key string, kept string, score string, size string"
    for name, rows in (("none", []), ("some", [(1, "a b", "en", None, 3, "r", "k", "y", "s", "z"), (None, None, None, None, None, None, None, None, None, None)])):
        docs = spark.createDataFrame(rows, columns)
        for stage, run in corpus_pipeline.STAGES:
            run(spark, docs, str(tmp_path / "sf")).write.parquet(str(tmp_path / name / stage))
            docs = spark.read.parquet(str(tmp_path / name / stage))
            got = Counter((r["doc_id"], r["text"]) if "text" in docs.columns else r["doc_id"] for r in docs.collect())
            if name == "none":
                assert not got
            elif stage in ("quality_classifier", "line_dedup", "minhash_near_dedup"):
                assert got == {(1, "a b"): 1, (None, None): 1}  # without labels nothing is rejected
            else:
                # a mix of one and a half times all words takes each once or twice
                assert {k[0] if isinstance(k, tuple) else k for k in got} == {1, None} and set(got.values()) <= {1, 2}
