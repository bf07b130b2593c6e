import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {k: v for k, v in entry.queries().items() if not k.startswith("op") and k != "pipeline"}


def plain(v):
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else repr(v)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = oracle.sql(sql)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
