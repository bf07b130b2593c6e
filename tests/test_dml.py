"""UPDATE, DELETE and MERGE against a plain reckoning, and what they leave alone."""

import uuid

import pytest
from pyspark.sql import functions as F

from siltworks.operators import commit, dml, publish


@pytest.fixture
def db(spark):
    name = f"m_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


@pytest.fixture(params=[[], ["part"]])
def target(spark, db, request):
    rows = spark.range(40).select("id", (F.col("id") * 10).alias("v"), F.when(F.col("id") % 4 < 3, F.concat(F.lit("p"), F.col("id") % 4)).alias("part"))
    publish.create(spark, f"{db}.t", publish.optional(rows.schema), request.param)
    publish.write(rows, f"{db}.t")
    return f"{db}.t"


def read(spark, table):
    return {r["id"]: (r["v"], r["part"]) for r in spark.table(table).collect()}


def part(k):
    return f"p{k % 4}" if k % 4 < 3 else None


def test_delete_and_update(spark, target):
    publish.query(spark, f"DELETE FROM {target} WHERE id % 4 = 1 AND id > 10 OR part IS NULL AND id < 9")
    want = {k: (k * 10, part(k)) for k in range(40) if not (k % 4 == 1 and k > 10 or k % 4 == 3 and k < 9)}
    assert read(spark, target) == want
    publish.query(spark, f"UPDATE {target} AS x SET v = x.v + 1, part = 'p9' WHERE id IN (0, 4)")
    publish.query(spark, f"UPDATE {target} SET v = 0 WHERE v < NULL")
    want |= {0: (1, "p9"), 4: (41, "p9")}
    assert read(spark, target) == want
    publish.query(spark, f"DELETE FROM {target}")
    assert read(spark, target) == {}
    with pytest.raises(ValueError, match="no column"):
        publish.query(spark, f"UPDATE {target} SET absent = 1 WHERE id = 1")


def test_merge(spark, target, db):
    publish.write(spark.createDataFrame([(1, None, None), (2, 5, "p2"), (100, 7, "p0"), (101, None, "new"), (102, 1, "x")], "id long, v long, part string"), f"{db}.s")
    publish.query(
        spark,
        f"MERGE INTO {target} AS t USING (SELECT * FROM {db}.s WHERE id < 102) AS s ON t.id = s.id "
        "WHEN MATCHED AND s.v IS NULL THEN DELETE WHEN MATCHED THEN UPDATE SET v = t.v + s.v "
        "WHEN NOT MATCHED AND s.part <> 'none' THEN INSERT (id, v, part) VALUES (s.id, coalesce(s.v, -1), s.part)",
    )
    want = {k: (k * 10, part(k)) for k in range(40) if k != 1} | {2: (25, "p2"), 100: (7, "p0"), 101: (-1, "new")}
    assert read(spark, target) == want
    publish.query(spark, f"MERGE INTO {target} t USING {db}.s s ON t.id = s.id WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT * WHEN NOT MATCHED BY SOURCE AND t.id > 10 THEN DELETE")
    want = {k: v for k, v in want.items() if k <= 10} | {1: (None, None), 2: (5, "p2"), 100: (7, "p0"), 101: (None, "new"), 102: (1, "x")}
    assert read(spark, target) == want


def test_two_source_rows_for_one_target_row(spark, target):
    source = spark.createDataFrame([(1, 1), (1, 2)], "id long, v long")
    before = read(spark, target)
    with pytest.raises(dml.SeveralMatches):
        dml.merge(spark, target, source, "t.id = s.id", [dml.Clause("update", None, (("v", "s.v"),))])
    assert read(spark, target) == before


def test_partitions_without_a_match_keep_their_files(spark, db):
    rows = spark.range(90).select("id", (F.col("id") % 3).alias("k"))
    publish.create(spark, f"{db}.t", publish.optional(rows.schema), ["k"])
    publish.write(rows, f"{db}.t")
    files = commit.Files(spark)
    of = lambda k: [f for f in files.data(commit.location(spark, f"{db}.t")) if f.startswith(f"k={k}/")]
    before = {k: of(k) for k in range(3)}
    source = spark.createDataFrame([(1, 1), (200, 2)], "id long, k long")
    dml.merge(spark, f"{db}.t", source, "t.id = s.id", [dml.Clause("delete")], [dml.Clause("insert", None, "*")])
    assert of(0) == before[0] and not set(of(1)) & set(before[1]) and set(of(2)) > set(before[2])
    assert sorted(r["id"] for r in spark.table(f"{db}.t").collect()) == [k for k in range(90) if k != 1] + [200]


def test_a_lost_driver_s_change_is_finished(spark, target, monkeypatch):
    real = commit.apply
    monkeypatch.setattr(commit, "apply", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        dml.change_rows(spark, target, "id = 3", None)
    monkeypatch.setattr(commit, "apply", real)
    dml.change_rows(spark, target, "id = 5", None)
    assert set(read(spark, target)) == set(range(40)) - {3, 5}
