"""Windows in a stream's state: late files, several micro-batches, and restarts from the checkpoint."""

import json
import os
import time
import uuid

import pytest

from siltworks.operators import publish
from siltworks.plans import rule as R
from siltworks.plans.ingest import Journal
from siltworks.streaming import windows


@pytest.fixture
def db(spark):
    name = f"w_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def put(folder, name, rows, at):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)) + "\n")
    os.utime(folder / name, (at, at))


def loaded(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(r["n"] for r in spark.table(table).collect())


def drain(query, want, seconds=90):
    """Let a query run until a condition holds."""
    end = time.time() + seconds
    while time.time() < end and not want():
        if query.exception():
            raise query.exception()
        time.sleep(0.3)
    query.stop()
    assert want()


def test_windows_late_files_and_restart(spark, db, tmp_path):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    rule = R.parse({"When": {"Suffix": ".json"}, "Dest": {"Table": f"{db}.t"}, "Batch": {"Window": {"DurationInSec": 60}}})
    journal, ran, now = Journal(spark, f"{db}.journal"), [], int(time.time()) // 60 * 60
    old, open_ = now - 600, now + 3_600
    put(tmp_path / "in", "a.json", [{"n": 1}], old + 1)
    put(tmp_path / "in", "b.json", [{"n": 2}], old + 2)
    put(tmp_path / "in", "c.json", [{"n": 3}], old + 70)
    put(tmp_path / "in", "later.json", [{"n": 9}], open_)
    start = lambda **more: windows.run_windows(spark, str(tmp_path / "in"), rule, str(tmp_path / "cp"), journal, trigger={"processingTime": "500 milliseconds"}, ran=ran, **more)
    drain(start(), lambda: len(ran) >= 2)
    assert loaded(spark, f"{db}.t") == [1, 2, 3]
    assert sorted(len(o.rows_from) for o in ran) == [1, 2]
    # a late file of a window that has run, after a restart; the open window is still open
    put(tmp_path / "in", "late.json", [{"n": 4}], old + 3)
    drain(start(), lambda: len(ran) >= 3)
    assert loaded(spark, f"{db}.t") == [1, 2, 3, 4] and len(ran[-1].rows_from) == 1
    # the window that was open before two restarts closes with its file once it is due
    put(tmp_path / "in", "also.json", [{"n": 10}], open_ + 1)
    drain(start(ahead_seconds=7_200), lambda: len(ran) >= 4)
    assert loaded(spark, f"{db}.t") == [1, 2, 3, 4, 9, 10] and len(ran[-1].rows_from) == 2


def test_a_batch_that_is_run_again_loads_once(spark, db, tmp_path):
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "n bigint").schema)
    rule = R.parse({"When": {"Suffix": ".json"}, "Dest": {"Table": f"{db}.t"}, "Batch": {"Window": {"DurationInSec": 60}}, "OnSuccess": [{"Action": "query", "Request": {"SQL": f"SELECT * FROM {db}.gate"}}]})
    journal, ran, old = Journal(spark, f"{db}.journal"), [], int(time.time()) - 900
    put(tmp_path / "in", "a.json", [{"n": 1}], old)
    start = lambda: windows.run_windows(spark, str(tmp_path / "in"), rule, str(tmp_path / "cp"), journal, trigger={"processingTime": "500 milliseconds"}, ran=ran)
    query = start()
    with pytest.raises(Exception, match="gate"):
        query.awaitTermination(90)
    assert loaded(spark, f"{db}.t") == [1] and not ran
    publish.create(spark, f"{db}.gate", spark.createDataFrame([], "k bigint").schema)
    drain(start(), lambda: len(ran) >= 1)
    assert loaded(spark, f"{db}.t") == [1]


def test_roll_over_is_refused(spark):
    rule = R.parse({"Dest": {"Table": "d.t"}, "Batch": {"Window": {"DurationInSec": 60}, "RollOver": True}})
    with pytest.raises(ValueError):
        windows.closed_windows(None, rule)
