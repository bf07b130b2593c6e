import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltworks.functions import dialect, naming
from siltworks.functions.naming import Param, SourceFile, TableRef

PAST = datetime(2021, 3, 9, 14, 30, tzinfo=timezone.utc)

#: Remainders that FNV-1 of these texts has.
VECTORS = [("", 4, 3), ("", 7, 0), ("gs://mybucket/data.avro", 7, 2)]


def test_hash_vectors():
    for text, divisor, rest in VECTORS:
        assert naming.fnv1(text) % divisor == rest


def test_hash_of_a_batch():
    import pandas as pd

    texts = pd.Series(["", "a", None, "grüße", "x" * 300, "a"], index=[9, 3, 5, 1, 0, 2])
    want = [naming.fnv1(t) if t is not None else None for t in texts]
    got = naming.fnv1_many(texts)
    assert [None if x is pd.NA else x for x in got] == want and list(got.index) == list(texts.index)
    assert len(naming.fnv1_many(pd.Series([], dtype=object))) == 0


@pytest.mark.parametrize(
    "text, want",
    [("p:d.t", ("p", "d", "t")), ("p.d.t", ("p", "d", "t")), ("d.t", (None, "d", "t")), ("d.t$x", (None, "d", "t$x"))],
)
def test_table_reference(text, want):
    ref = TableRef.parse(text)
    assert (ref.project, ref.dataset, ref.table) == want


def test_table_reference_refused():
    with pytest.raises(ValueError):
        TableRef.parse("table")


def test_expand():
    f = SourceFile("s3://garden/beds/north/17/roses.csv", PAST)
    beds = r"/beds/(\w+)/(\d+)/"
    assert naming.expand("plots.bed_$1_$2", f, beds) == "plots.bed_north_17"
    assert naming.expand("plots.day_$Date", f) == "plots.day_20210309"
    assert naming.expand("t_$Hour", f) == "t_02" and naming.expand("t_$Hour", f, hour24=True) == "t_14"
    assert naming.expand("t_$Mod(5)", f) == f"t_{naming.fnv1(f.url) % 5}"
    with pytest.raises(re.error):
        naming.expand("t_$1", f, r"/beds/(\w+")


def test_named_parameters():
    f = SourceFile("s3://garden/beds/North-East/17/roses.csv", PAST)
    p = [Param("Bed", "$Replace($ToUpper($1),'-','')"), Param("BedNo", "$Bed$2")]
    assert naming.expand("plots.$Bed.$Bed", f, r"/beds/([\w-]+)/(\d+)/", p) == "plots.NORTHEAST.NORTHEAST"


def test_tenth_group():
    f = SourceFile("/" + "/".join("abcdefghij"), PAST)
    assert naming.expand("$10$1", f, "/" + "/".join(["(.)"] * 10)) == "ja"


@pytest.mark.parametrize("at, end", [(24, 30), (30, 40), (21, 30)])
def test_window_end(at, end):
    assert naming.window_end(at, 10) == end


def test_window_file():
    assert naming.end_of_window_file("s3://ops/windows/plots.beds_1700000090.win") == 1700000090
    with pytest.raises(ValueError):
        naming.end_of_window_file("s3://ops/windows/plots.beds.win")


NAMES = ["plots.beds/e12_00007_copy--dispatch", "beds--e9--tail", "beds", "a/b--e1_3_load--tail.json"]


def test_activity_id(spark):
    assert naming.activity_id("plots.beds", "e12", 100_006, "copy", "dispatch") == NAMES[0]
    assert naming.parse_activity_id(NAMES[0]) == {"table": "plots.beds", "event_id": "e12", "step": 7, "action": "copy", "mode": "dispatch"}
    assert naming.parse_activity_id(NAMES[1]) == {"table": "beds", "event_id": "e9", "step": 0, "action": "nop", "mode": "tail"}
    got = spark.createDataFrame([(n,) for n in NAMES], "n string").select(naming.activity_parts(F.col("n")).alias("x")).collect()
    assert [r["x"].asDict() for r in got] == [naming.parse_activity_id(n) for n in NAMES]


def test_variables():
    v = naming.Variables({"EventID": 7, "LoadURIs": ["a", "b"], "Data": {"BatchID": 3}})
    assert v.put("x_$EventID ${EventID} $Data.BatchID $None") == "x_7 7 3 $None"
    # a name ends where the longest known one does
    w = naming.Variables({"EventID": 7, "DestTable": "d.t", "Dest": "x", "Data": {"BatchID": 3}})
    assert w.put("s3://b/$EventID.csv $DestTable_$EventID $Data.BatchID.gz ${EventID}9 ${Event} $Data.Other") == "s3://b/7.csv d.t_7 3.gz 79 ${Event} {'BatchID': 3}.Other"
    assert v.put_all({"urls": "$LoadURIs", "text": "of $LoadURIs"}) == {"urls": ["a", "b"], "text": "of a,b"}


def test_dialect():
    put = dialect.to_spark
    assert put("TIMESTAMP(NULL)") == "CAST(NULL AS TIMESTAMP)"
    assert put("SPLIT(s, '.')") == r"SPLIT(s, '\\Q.\\E')" and put("SPLIT(f(s, 1), '.')") == r"SPLIT(f(s, 1), '\\Q.\\E')"
    assert put("SELECT 1 FROM `p.d.t`") == "SELECT 1 FROM `d`.`t`"
    assert put("SELECT 1 FROM [p:d.t] JOIN [d.u$x] ON 1 = 1") == "SELECT 1 FROM d.t JOIN d.u$x ON 1 = 1"
    same = ["t.items[t.idx]", "x RLIKE '[a-z.0-9]'", "'from [p:d.t] INT64(NULL) `a.b`'", "1 -- from [p:d.t]", "/* from [d.t] */ 1", 'f("SPLIT(s, \'.\')")', "concat(a, '.')"]
    assert [put(x) for x in same] == same
    assert put("SELECT i.n FROM t, UNNEST(t.items) AS i") == "SELECT i.n FROM t, LATERAL explode(t.items) AS i_(i)"
    assert dialect.is_dml("INSERT INTO t SELECT 1") and not dialect.is_dml("SELECT 'insert'")
    assert dialect.is_dml("WITH a AS (SELECT 1) DELETE FROM t") and not dialect.is_dml("WITH a AS (SELECT 1) SELECT * FROM a")


def test_dialect_runs(spark):
    nested = "SELECT * FROM VALUES (1, array(named_struct('n', 2L), named_struct('n', 3L))), (2, array()) t(k, items)"
    spark.sql(nested).createOrReplaceTempView("nested_items")
    rows = spark.sql(dialect.to_spark("SELECT t.k, i.n FROM nested_items t JOIN UNNEST(t.items) i ORDER BY i.n")).collect()
    assert [tuple(r) for r in rows] == [(1, 2), (1, 3)]
    sums = spark.sql(dialect.to_spark("SELECT k, (SELECT SUM(i.n) AS s FROM UNNEST(items) i) AS total FROM nested_items ORDER BY k")).collect()
    assert [tuple(r) for r in sums] == [(1, 5), (2, None)]
    got = spark.sql(dialect.to_spark("SELECT k, items[k].n AS n FROM nested_items WHERE 'a.b' RLIKE '[a-z.0-9]' AND k = 1")).first()
    assert tuple(got) == (1, 3)


def test_split_is_literal(spark):
    row = spark.sql("SELECT 'a.b' AS s").selectExpr(dialect.to_spark("SPLIT(s, '.')") + " AS x").first()
    assert row["x"] == ["a", "b"]


def test_columns_of_names_agree_with_names(spark):
    """Every file at once and one by one give the same destinations."""
    from datetime import datetime, timedelta, timezone

    from pyspark.sql import functions as F

    params = [naming.Param("Kind", "$Replace($ToUpper($1), 'I', 'X')_k"), naming.Param("KindOf", "of_$2"), naming.Param("Odd", "$ToLower($Replace($1, C, '.'))-$9")]
    pattern, at = r"/data/([^/]+)/(\d*)", datetime(2024, 2, 29, 23, 30, tzinfo=timezone.utc)
    urls = ["s3://lake/data/click/12/a.json", "s3://lake/data/viEw/x.json", "file:/data/Cc/7", "hdfs://h:9/other/é.json", "/data/a.b-c/0/z"]
    files = [naming.SourceFile(u, at + timedelta(hours=7 * k)) for k, u in enumerate(urls)]
    df = spark.createDataFrame([(f.url, f.modified) for f in files], "url string, modified timestamp")
    for text in ("lake.t_$1_$Date", "p:lake.$Kind$Hour", "p.lake.t_$Mod(7)_$KindOf_${Odd}_$2$3", "lake.plain"):
        for hour24 in (False, True):
            got = [r[0] for r in df.select(naming.expanded(text, F.col("url"), F.col("modified"), pattern, params, hour24)).collect()]
            assert got == [naming.expand(text, f, pattern, params, hour24) for f in files]
    names = ["p:d.t", "p.d.t$20240101", "d.t", "`p.d.t`"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(naming.table_name(F.col("n"))).collect()]
    assert got == [naming.TableRef.parse(n).name for n in names]
