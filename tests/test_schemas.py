from pyspark.sql import types as T

from siltworks.functions import schemas as S
from siltworks.plans import queries


def test_infer():
    got = S.infer_line('{"a": "x", "b": true, "c": 1, "d": 3.2, "e": null, "f": [1, 2], "g": {"h": 1}, "i": [{"x": 1}, {"y": "t"}]}')
    assert got.simpleString() == "struct<a:string,b:boolean,c:bigint,d:double,e:string,f:array<bigint>,g:struct<h:bigint>,i:array<struct<x:bigint,y:string>>>"


def test_from_fields():
    got = S.from_fields([{"name": "id", "type": "INT64", "mode": "REQUIRED"}, {"Name": "r", "Type": "RECORD", "Mode": "REPEATED", "Fields": [{"name": "k", "type": "STRING"}]}])
    assert got.simpleString() == "struct<id:bigint,r:array<struct<k:string>>>" and not got["id"].nullable


def test_comparisons():
    a = T._parse_datatype_string("id bigint, s struct<x:string,y:int>")
    b = T._parse_datatype_string("s struct<y:int,x:string>, ID bigint")
    wider = T._parse_datatype_string("id bigint, s struct<x:string,y:int>, note string")
    assert S.equal(a, b) and S.patchable(a, wider) and not S.patchable(wider, a)
    assert S.can_copy(a, wider) and not S.can_copy(wider, a)
    assert S.unknown_fields(T._parse_datatype_string("id bigint, s struct<x:string,z:int>, w int"), a) == ["s.z", "w"]
    assert S.merge(T.LongType(), T.DoubleType()) == T.DoubleType()


def test_fields_are_inferred_from_all_rows(spark, tmp_path):
    rows = [("a", None), ("a", '{"j": 1}'), ("a", '{"k": 2}'), ("b", '{"k": 2.5}'), ("b", "no json")]
    spark.createDataFrame(rows, "event_type string, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = queries.QUERIES["json_field_inference"](spark, str(tmp_path)).collect()
    assert {r["event_type"]: (r["n"], float(r["k"])) for r in got} == {"a": (3, 2.0), "b": (2, 2.5)}
