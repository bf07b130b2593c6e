from datetime import datetime, timedelta, timezone

import pytest

from siltworks.operators import publish as P


@pytest.fixture
def db(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def rows(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=str)


def test_append_truncate_columns(spark, db):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    P.write(df, f"{db}.t")
    P.write(df.select("name", "id"), f"{db}.t")
    assert len(rows(spark, f"{db}.t")) == 4
    P.write(df, f"{db}.t", append=False)
    P.insert_columns(df, f"{db}.t", ["id"])
    assert rows(spark, f"{db}.t") == [(1, "a"), (1, None), (2, "b"), (2, None)]


def test_partition_override(spark, db):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, p string")
    P.create(spark, f"{db}.t", df.schema, ["p"])
    P.write(df, f"{db}.t")
    P.override_partitions(spark.createDataFrame([(9, "x")], "id int, p string"), f"{db}.t", {"p": "x"})
    assert rows(spark, f"{db}.t") == [(2, "y"), (9, "x")]
    with pytest.raises(Exception, match="outside partition"):
        P.override_partitions(spark.createDataFrame([(7, "z")], "id int, p string"), f"{db}.t", {"p": "x"})
    P.write(spark.createDataFrame([(5, "q")], "id int, p string"), f"{db}.t", append=False)
    assert rows(spark, f"{db}.t") == [(5, "q")]


def test_patch_nested(spark, db):
    P.write(spark.createDataFrame([(1, [("a",)])], "id int, params array<struct<key:string>>"), f"{db}.t")
    wider = spark.createDataFrame([], "id int, params array<struct<key:string,value:int>>, note string").schema
    P.patch(spark, f"{db}.t", wider)
    P.write(spark.createDataFrame([(2, [("b", 3)], "n")], wider), f"{db}.t")
    assert rows(spark, f"{db}.t") == [(1, [("a", None)], None), (2, [("b", 3)], "n")]


def test_required(spark, db):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType(), False)])
    P.create(spark, f"{db}.t", schema)
    with pytest.raises(Exception, match="required column"):
        P.write(spark.createDataFrame([(None,)], "id int"), f"{db}.t", schema=schema)


def test_split_and_copy(spark, db):
    df = spark.range(6).selectExpr("id", "named_struct('key', id % 2) AS info")
    flat = P.split_columns(df, ["info.key"], "ts")
    P.write_split(flat, [("key = 0", f"{db}.s0"), ("id > 2", f"{db}.s1")])
    assert [r[0] for r in rows(spark, f"{db}.s0")] == [0, 2, 4] and [r[0] for r in rows(spark, f"{db}.s1")] == [3, 4, 5]
    assert sorted(r["dest"] for r in P.split(flat, [("key = 0", "a"), ("id > 2", "b")]).collect()) == ["a"] * 3 + ["b"] * 3
    P.copy(spark, f"{db}.s0", f"{db}.c")
    P.copy(spark, f"{db}.s0", f"{db}.c", append=True)
    assert len(rows(spark, f"{db}.c")) == 6


def test_expiry_and_dml(spark, db):
    now = datetime.now(timezone.utc)
    P.write(spark.range(1).toDF("id"), f"{db}.t")
    P.set_expiry(spark, f"{db}.t", 60, now)
    assert P.sweep(spark, db, now) == []
    P.query(spark, f"INSERT INTO {db}.t VALUES (5)")
    P.insert(spark, [{"id": 6}], f"{db}.t")
    P.insert(spark, "SELECT 7 AS id", f"{db}.t")
    assert rows(spark, f"{db}.t") == [(0,), (5,), (6,), (7,)]
    assert P.sweep(spark, db, now + timedelta(seconds=61)) == [f"{db}.t"]
