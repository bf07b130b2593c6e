"""Changes of several tables as one: crashes planted between steps, retries, claims, compaction, footers."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltworks.functions.naming import SourceFile
from siltworks.operators import commit, publish
from siltworks.plans import rule as R
from siltworks.plans.ingest import Context, Journal, ingest
from siltworks.sources import recovery
from siltworks.sources.files import LoadOptions

NOW = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


@pytest.fixture
def db(spark):
    import uuid

    name = f"c_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def lines(folder, name, rows):
    path = folder / name
    path.write_text("\n".join(map(json.dumps, rows)) + "\n")
    return SourceFile(str(path), NOW)


def split_rule(db):
    mapping = [{"When": f"MOD(n, 3) = {k}", "Then": f"{db}.t{k}"} for k in range(3)]
    return R.parse({"Dest": {"Table": f"{db}.t", "Transient": {"Dataset": "x"}, "Schema": {"Template": f"{db}.t", "Split": {"Mapping": mapping}}}})


def contents(spark, db, names):
    return {t: sorted(r["n"] for r in spark.table(f"{db}.{t}").collect()) if publish.exists(spark, f"{db}.{t}") else [] for t in names}


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_crash_between_tables_leaves_all_or_none(spark, db, tmp_path, monkeypatch, at):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    file, journal = lines(tmp_path, "a.json", [{"n": k} for k in range(9)]), Journal(spark, f"{db}.journal")
    done, real = [], commit.apply

    def crash(spark_, change):
        if len(done) == at:
            raise RuntimeError("lost")
        real(spark_, change)
        done.append(change.table)

    with monkeypatch.context() as m:
        m.setattr(commit, "apply", crash)
        with pytest.raises(RuntimeError):
            ingest(spark, split_rule(db), [file], "e", journal)
    for _ in range(2):  # the second run finds it done
        ingest(spark, split_rule(db), [file], "e", journal)
        assert contents(spark, db, ("t0", "t1", "t2")) == {"t0": [0, 3, 6], "t1": [1, 4, 7], "t2": [2, 5, 8]}


def test_a_crash_before_the_record_leaves_none(spark, db, tmp_path, monkeypatch):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    file, journal = lines(tmp_path, "a.json", [{"n": k} for k in range(9)]), Journal(spark, f"{db}.journal")
    with monkeypatch.context() as m:
        m.setattr(commit.Files, "create", lambda self, url, text, real=commit.Files.create: (_ for _ in ()).throw(OSError("lost")) if "/_commits/" in url else real(self, url, text))
        with pytest.raises(OSError):
            ingest(spark, split_rule(db), [file], "e", journal)
    assert contents(spark, db, ("t0", "t1", "t2")) == {"t0": [], "t1": [], "t2": []}
    ingest(spark, split_rule(db), [file], "e", journal)
    assert contents(spark, db, ("t0", "t1", "t2")) == {"t0": [0, 3, 6], "t1": [1, 4, 7], "t2": [2, 5, 8]}


def test_a_run_whose_action_fails_loads_once(spark, db, tmp_path):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    rule = R.parse({"Dest": {"Table": f"{db}.t"}, "OnSuccess": [{"Action": "call", "Request": {}}]})
    file, journal, calls = lines(tmp_path, "a.json", [{"n": 1}]), Journal(spark, f"{db}.journal"), []

    def service(_):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("no answer")

    with pytest.raises(RuntimeError):
        ingest(spark, rule, [file], "e", journal, Context(spark, services={"call": service}))
    assert contents(spark, db, ["t"]) == {"t": [1]}
    ingest(spark, rule, [file], "e", journal, Context(spark, services={"call": service}))
    assert contents(spark, db, ["t"]) == {"t": [1]} and len(calls) == 2 and journal.done("e")


def test_overwrite_and_partitions(spark, db):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "x/y=%")], "n long, k string")
    publish.create(spark, f"{db}.p", rows.schema, ["k"])
    done = commit.Commits(spark, None)
    read = lambda: sorted((tuple(r) for r in spark.table(f"{db}.p").collect()), key=str)
    done.publish("1", [commit.stage(rows, f"{db}.p")])
    assert read() == [(1, "a"), (2, "b"), (3, None), (4, "x/y=%")]
    done.publish("2", [commit.stage(rows.where("n in (1, 3, 4)").withColumn("n", F.col("n") + 10), f"{db}.p", commit.PARTITIONS)])
    assert read() == [(11, "a"), (13, None), (14, "x/y=%"), (2, "b")]
    done.publish("3", [commit.stage(rows.limit(0), f"{db}.p", commit.PARTITIONS, touched=rows.where("n = 2 or n = 4"))])
    assert read() == [(11, "a"), (13, None)]
    done.publish("4", [commit.stage(rows.where("n = 2"), f"{db}.p", commit.OVERWRITE)])
    assert read() == [(2, "b")] and [r[0] for r in publish.partitions(spark, f"{db}.p").collect()] == ["b"]


def test_append_to_a_named_partition(spark, db, tmp_path):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint, day date").schema, ["day"])
    rule = R.parse({"Dest": {"Table": f"{db}.t$20260101"}})
    ingest(spark, rule, [lines(tmp_path, "a.json", [{"n": 1, "day": "2026-01-01"}])], "1")
    with pytest.raises(Exception, match="outside partition"):
        ingest(spark, rule, [lines(tmp_path, "b.json", [{"n": 2, "day": "2026-01-01"}, {"n": 3, "day": "2026-01-02"}])], "2")
    assert contents(spark, db, ["t"]) == {"t": [1]}


def test_claims(spark, db):
    one, two = Journal(spark, f"{db}.journal"), Journal(spark, f"{db}.journal")
    assert one.claim("e") and one.claim("e") and not two.claim("e")
    two.release("e")
    assert not two.claim("e")
    one.release("e")
    assert two.claim("e")
    lost = Journal(spark, f"{db}.journal", lease=-1)
    assert lost.claim("f") and two.claim("f") and not one.claim("f")


def test_two_drivers_of_one_event_load_once(spark, db, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    file, rule = lines(tmp_path, "a.json", [{"n": 1}]), R.parse({"Dest": {"Table": f"{db}.t"}})
    with ThreadPoolExecutor(4) as pool:
        out = list(pool.map(lambda _: ingest(spark, rule, [file], "e", Journal(spark, f"{db}.journal")), range(4)))
    assert sum(not o.skipped for o in out) == 1 and contents(spark, db, ["t"]) == {"t": [1]}


def test_a_journal_of_many_events_stays_in_few_files(spark, db):
    journal = Journal(spark, f"{db}.journal", files=8)
    for k in range(30):
        journal.put(f"e{k}", "r", "d.t", "running", [f"u{k}"])
        if k % 2:
            journal.put(f"e{k}", "r", "d.t", "done", [f"u{k}"])
    assert len(journal.files.data(journal.folder)) <= 12
    states = {r["event_id"]: r["state"] for r in journal.latest().collect()}
    assert states == {f"e{k}": "done" if k % 2 else "running" for k in range(30)} and journal.done("e7") and not journal.done("e8")
    assert spark.table(f"{db}.journal").count() == 45


def test_metrics_of_a_load_come_from_its_write(spark, db, tmp_path):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    journal = Journal(spark, f"{db}.journal")
    (tmp_path / "bad.json").write_text("{\n")
    ingest(spark, split_rule(db), [lines(tmp_path, "a.json", [{"n": k} for k in range(7)]), SourceFile(str(tmp_path / "bad.json"), NOW)], "e", journal)
    row = spark.table(f"{db}.journal_loads").first()
    assert (row["event_id"], row["rows"]) == ("e", 7) and sorted(f["kind"] for f in row["files"]) == ["corrupted", "valid"]


def test_schema_from_footers(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "n int, k string").write.parquet(str(tmp_path / "narrow"))
    spark.createDataFrame([(2, 0.5)], "n bigint, extra double").write.parquet(str(tmp_path / "more"))
    spark.createDataFrame([("x",)], "n string").write.parquet(str(tmp_path / "unfit"))
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 not really PAR1")
    urls = [str(next((tmp_path / d).glob("*.parquet"))) for d in ("narrow", "more", "unfit")] + [str(tmp_path / "broken.parquet")]
    schema = spark.createDataFrame([], "n bigint, k string").schema
    wide = recovery.new_fields(spark, urls, schema, LoadOptions("parquet"))
    assert [(f.name, f.dataType.simpleString()) for f in wide] == [("n", "bigint"), ("k", "string"), ("extra", "double")]
    got = recovery.classify(spark, urls, wide, LoadOptions("parquet"))
    assert got.valid == urls[:2] and got.invalid_schema == [urls[2]] and got.corrupted == [urls[3]]
    strict = recovery.classify(spark, urls[:2], schema, LoadOptions("parquet"))
    assert strict.valid == urls[:1] and strict.invalid_schema == [urls[1]]
    loose = recovery.classify(spark, urls[:2], schema, LoadOptions("parquet", ignore_unknown_values=True))
    assert loose.valid == urls[:2]


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_field_addition_of_columnar_files(spark, db, tmp_path, kind):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    spark.createDataFrame([(1, "new", (2,))], "n bigint, k string, s struct<a:int>").coalesce(1).write.format(kind).save(str(tmp_path / "in"))
    url = str(next((tmp_path / "in").glob(f"*.{kind}")))
    rule = R.parse({"Dest": {"Table": f"{db}.t", "SourceFormat": kind.upper(), "AllowFieldAddition": True}})
    ingest(spark, rule, [SourceFile(url, NOW)], "1")
    row = spark.table(f"{db}.t").first()
    assert (row["n"], row["k"], row["s"]["a"]) == (1, "new", 2)


def test_fields_named_like_types(spark, db, tmp_path):
    from pyspark.sql import types as T

    assert recovery.parse_variant_schema("OBJECT<AVOID: BIGINT, VOID: VOID, `OBJECT<`: ARRAY<OBJECT<VARIANT: VARIANT>>>") == T._parse_datatype_string(
        "struct<AVOID:bigint,VOID:string,`OBJECT<`:array<struct<VARIANT:string>>>"
    )
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "AVOID bigint").schema)
    out = ingest(spark, R.parse({"Dest": {"Table": f"{db}.t"}}), [lines(tmp_path, "a.json", [{"AVOID": 1}])], "1")
    assert not out.invalid_schema and spark.table(f"{db}.t").count() == 1


def test_clustered_files_skip(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 200).alias("a"), (F.col("id") * 7919 % 40_000).cast("string").alias("b"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("c"))
    got = publish.clustered(rows, ["a", "b"])
    assert got.exceptAll(rows).isEmpty() and got.count() == 40_000
    got.write.option("maxRecordsPerFile", 2_500).parquet(str(tmp_path / "z"))
    import pyarrow.parquet as pq

    groups = [pq.ParquetFile(f).metadata.row_group(0) for f in (tmp_path / "z").glob("*.parquet")]
    for k, value in ((0, 17), (1, "23456")):
        kept = sum(g.column(k).statistics.min <= value <= g.column(k).statistics.max for g in groups)
        assert kept <= len(groups) // 2


def test_required_columns_and_their_relaxation(spark, db, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("k", T.StringType(), False)])
    publish.create(spark, f"{db}.t", schema)
    assert publish.required_columns(spark, f"{db}.t") == ["n", "k"]
    file = lines(tmp_path, "a.json", [{"n": 1, "k": "x"}, {"n": 2}])
    with pytest.raises(Exception, match="null in required column k"):
        ingest(spark, R.parse({"Dest": {"Table": f"{db}.t"}}), [file], "1")
    with pytest.raises(Exception, match="null in required column k"):
        publish.write(spark.createDataFrame([(3, None)], "n long, k string"), f"{db}.t")
    assert contents(spark, db, ["t"]) == {"t": []}
    ingest(spark, R.parse({"Dest": {"Table": f"{db}.t", "SchemaUpdateOptions": ["ALLOW_FIELD_RELAXATION"]}}), [file], "2")
    assert contents(spark, db, ["t"]) == {"t": [1, 2]} and publish.required_columns(spark, f"{db}.t") == ["n"]
    ingest(spark, R.parse({"Dest": {"Table": f"{db}.t"}}), [lines(tmp_path, "b.json", [{"n": 5}])], "3")
    assert contents(spark, db, ["t"]) == {"t": [1, 2, 5]}
