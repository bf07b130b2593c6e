"""Secret patterns on texts made to send a matcher deep or back again and again."""

import time

import pytest
from pyspark.sql import functions as F

from siltworks.llm import secrets

MB = 1 << 20
UNITS = ["a.", "-.", "1.1", "a.bc", "a-", ".", "user ", "user:", "token=", "AKIA", "http://", "a+", "aA1", "secret ' "]


@pytest.mark.parametrize("unit", UNITS)
def test_a_megabyte_of_one_form(spark, unit):
    text = unit * (MB // len(unit))
    tail = " db.example.org:5432 password=hunter22"
    docs = spark.createDataFrame([(1, text + tail)], "doc_id long, text string")
    began = time.time()
    row = secrets.scan_secrets(docs).first()
    assert time.time() - began < 60
    found = {(s["kind"], text[s["start"] : s["end"]] if s["end"] <= len(text) else (text + tail)[s["start"] : s["end"]]) for s in row["linked"]}
    assert ("endpoint", "db.example.org:5432") in found and ("weak_secret", "password=hunter22") in found


def test_hosts_begin_and_end_where_they_should(spark):
    text = "a.bc:80 x.y.zz:1234, (q-1.example.com:99) up.UP.com:80 .lead.com:80 a..b.com:80 one:80 a.b1:80 a.bc:1 a.bc:123456 -d.ef:22"
    hits = spark.range(1).select(F.regexp_extract_all(F.lit(text), F.lit(secrets.ENDPOINT), F.lit(0)).alias("x")).first()["x"]
    assert hits == ["a.bc:80", "x.y.zz:1234", "q-1.example.com:99", "-d.ef:22"]
