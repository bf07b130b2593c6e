import pytest
from pyspark.sql import types as T

from siltworks.operators import transform as tr


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([(1, "a", 5), (1, None, 7), (2, "b", 1), (2, "b", 1)], "id int, name string, v int")


def test_projection_order():
    schema = T._parse_datatype_string("id int, Name string, gone int")
    got = tr.projection(schema, {"name": "upper(t.Name)", "z": "1", "b": "2"}, T._parse_datatype_string("id int, name string, b int, z int"))
    assert got == [("id", "t.`id`"), ("Name", "upper(t.Name)"), ("b", "2"), ("z", "1")]


def test_dedupe_is_by_column(events):
    got = tr.transform(events, keys=["id"], columns={"v": "t.v * 2"})
    assert sorted(map(tuple, got.collect())) == [(1, "a", 14), (2, "b", 2)]


def test_nested_dedupe_keeps_whole_rows(spark):
    df = spark.createDataFrame([(1, [1], 5), (1, [2], 3), (None, [3], 1)], "id int, refs array<int>, v int")
    got = tr.transform(df, keys=["id"], order=["v"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, [2], 3), (None, [3], 1)]


def test_sides_chain(spark, events):
    a = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    b = spark.createDataFrame([(1, "one")], "x int, label string")
    sides = [(tr.SideInput("p", "t.name = p.k", table="d.a"), a), (tr.SideInput("q", "p.x = q.x", table="d.b"), b)]
    got = tr.transform(events, columns={"label": "q.label"}, sides=sides)
    assert sorted(got.select("v", "label").collect(), key=str) == [(1, None), (1, None), (5, "one"), (7, None)]


def test_criteria_and_refusal(events):
    assert tr.transform(events, criteria="t.v > 4").count() == 2
    with pytest.raises(ValueError):
        tr.transform(events, keys=["id"], columns={"ID": "1"})
