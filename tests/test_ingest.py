import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltworks.functions.naming import SourceFile
from siltworks.operators import publish
from siltworks.plans import rule as R
from siltworks.plans.ingest import Context, Journal, ingest, run_actions
from siltworks.sources import files as fs
from siltworks.sources import recovery
from siltworks.streaming.ingest import collect_manifest, run_due, windowed_counts


@pytest.fixture
def db(spark):
    import uuid

    name = f"i_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def put(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(path)


def garden(spark, table):
    publish.create(spark, table, spark.createDataFrame([], "shelf bigint, plant bigint, label string").schema)


GOOD = {"shelf": 3, "plant": 1, "label": "fern"}
NOW = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


def test_classify(spark, tmp_path):
    schema = spark.createDataFrame([], "shelf bigint, plant bigint, label string").schema
    unknown = put(tmp_path, "unknown.json", [{**GOOD, "colour": 1}])
    typed = put(tmp_path, "typed.json", [{"shelf": 1, "plant": "moss"}])
    corrupt = put(tmp_path, "corrupt.json", ['{"shelf": 1, '])
    good = put(tmp_path, "good.json", [GOOD])
    got = recovery.classify(spark, [unknown, typed, corrupt, good, str(tmp_path / "no.json")], schema)
    assert got.valid == [good] and got.corrupted == [corrupt]
    assert sorted(got.invalid_schema) == sorted([unknown, typed]) and got.missing == [str(tmp_path / "no.json")]


def test_bad_records(spark, tmp_path):
    schema = spark.createDataFrame([], "shelf bigint, label string").schema
    path = put(tmp_path, "a.csv", ["1,x", "oops,y", "3,z"])
    with pytest.raises(fs.TooManyBadRecords):
        fs.load(spark, [path], schema)
    assert fs.load(spark, [path], schema, fs.LoadOptions(max_bad_records=1)).count() == 2


def test_rule_validation():
    with pytest.raises(R.InvalidRule):
        R.parse({"Dest": {"Table": "d.t", "UniqueColumns": ["shelf"]}})
    with pytest.raises(R.InvalidRule):
        R.parse({"Dest": {"Table": "d.t", "Transient": {"Dataset": "x"}, "SideInputs": [{"Table": "d.f", "Alias": "f", "On": "f.shelf = 1"}]}})
    with pytest.raises(R.InvalidRule):
        R.Action.load({"Action": "delete", "OnSuccess": [{"Action": "drop", "Request": {"Table": "x"}}]})
    r = R.parse({"When": {"Prefix": "/a"}, "Dest": {"Table": "d.t", "Transient": {"Dataset": "x"}, "UniqueColumns": ["shelf"]}, "Batch": {}})
    assert r.method == "QUERY" and r.append and r.window_seconds is None
    assert R.rule_for([r], "/a/b.json") is r and R.rule_for([r], "/b") is None
    with pytest.raises(R.SeveralRules):
        R.rule_for([r, r], "/a")


def test_ingest_with_actions(spark, db, tmp_path):
    garden(spark, f"{db}.t")
    a = put(tmp_path, "data/a.json", [GOOD, {**GOOD, "shelf": 4}])
    b = put(tmp_path, "data/b.json", [{**GOOD, "label": "zz"}])
    bad = put(tmp_path, "data/c.json", ["{"])
    rule = R.parse(
        {
            "When": {"Prefix": "/"},
            "Dest": {"Table": f"{db}.t", "Transient": {"Dataset": "tmp"}, "UniqueColumns": ["shelf"], "Transform": {"label": "upper(t.label)"}},
            "OnSuccess": [
                {"Action": "query", "Request": {"SQL": "SELECT '$EventID' AS event_id, COUNT(1) AS row_count FROM $TempTable", "Dest": f"{db}.summary", "Append": True}, "OnSuccess": [{"Action": "delete"}]},
                {"Action": "drop", "When": {"Exists": f"{db}.none"}, "Request": {"Table": f"{db}.t"}},
            ],
        },
        "rule.yaml",
    )
    journal = Journal(spark, f"{db}.journal")
    files = [SourceFile(u, NOW) for u in (a, b, bad)]
    out = ingest(spark, rule, files, "77", journal)
    assert out.corrupted == [bad] and sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(3, 1, "ZZ"), (4, 1, "FERN")]
    assert spark.table(f"{db}.summary").collect() == [("77", 3)]
    assert not os.path.exists(a) and journal.latest().first()["state"] == "done"
    assert ingest(spark, rule, files, "77", journal).skipped


def test_field_addition(spark, db, tmp_path):
    """Fields that a table lacks come in at the top, in a struct and in the structs of an array."""
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "shelf bigint, pot struct<clay:boolean>, visits array<struct<day:string>>").schema)
    publish.write(spark.createDataFrame([(8, (True,), [("mon",)])], "shelf bigint, pot struct<clay:boolean>, visits array<struct<day:string>>"), f"{db}.t")
    path = put(tmp_path, "a.json", [{"shelf": 1, "pot": {"clay": False, "litres": 2.5}, "visits": [{"day": "tue", "by": "ann"}], "height": 40}])
    rule = R.parse({"Dest": {"Table": f"{db}.t", "SchemaUpdateOptions": ["ALLOW_FIELD_ADDITION"]}})
    ingest(spark, rule, [SourceFile(path, NOW)], "1")
    old, new = sorted(spark.table(f"{db}.t").collect(), key=lambda r: -r["shelf"])
    assert (new["height"], new["pot"]["litres"], new["visits"][0]["by"]) == (40, 2.5, "ann")
    assert (old["height"], old["pot"]["litres"], old["visits"][0]["by"], old["visits"][0]["day"]) == (None, None, None, "mon")


def test_split_rule_and_parameters(spark, db, tmp_path):
    garden(spark, f"{db}.template")
    path = put(tmp_path, "beds/2020/01/02/x.json", [GOOD, {**GOOD, "shelf": 4}])
    rule = R.parse(
        {
            "Dest": {
                "Table": f"{db}.t_$1$2$3",
                "Pattern": r"beds/(\d{4})/(\d{2})/(\d{2})/",
                "Parameters": [{"Name": "Bed", "Expression": "bed_$1"}],
                "Transient": {"Dataset": "tmp"},
                "Schema": {"Template": f"{db}.template", "Split": {"Mapping": [{"When": "MOD(shelf, 2) = 0", "Then": f"{db}.even_$1"}, {"When": "MOD(shelf, 2) = 1", "Then": f"{db}.odd_$1"}]}},
            }
        }
    )
    ingest(spark, rule, [SourceFile(path, NOW)], "5")
    assert spark.table(f"{db}.even_2020").first()["shelf"] == 4 and spark.table(f"{db}.odd_2020").first()["shelf"] == 3


def test_failure_actions(spark, db):
    seen = []
    ctx = Context(spark, services={"notify": seen.append})
    actions = [R.Action.load({"Action": "query", "Request": {"SQL": "SELECT * FROM absent_table"}, "OnFailure": [{"Action": "notify", "Request": {"Body": "failed: $Error"}}]})]
    run_actions(actions, ctx)
    assert "absent_table" in seen[0]["body"]


def test_group_barrier(spark):
    seen = []
    ctx = Context(spark, services={"push": seen.append}, groups={"9": 2})
    action = R.Action.load({"Action": "group", "Request": {"ID": "9"}, "OnSuccess": [{"Action": "push"}]})
    run_actions([action], ctx)
    assert not seen
    run_actions([action], ctx)
    assert len(seen) == 1


def test_windows(spark):
    files = spark.createDataFrame(
        [("s3://b/x/1.json", "2024-01-01 00:00:24"), ("s3://b/x/2.json", "2024-01-01 00:00:30"), ("s3://b/y/3.json", "2024-01-01 00:00:21")], "url string, modified string"
    ).withColumn("modified", F.to_timestamp("modified"))
    apart = fs.batch_windows(files, 10, F.lit("d.t"))
    ends = {r["url"]: r["window_end"].second for r in apart.collect()}
    assert ends == {"s3://b/x/1.json": 30, "s3://b/x/2.json": 40, "s3://b/y/3.json": 30}
    assert apart.select("group").distinct().count() == 2
    together = fs.batch_windows(files, 10, F.lit("d.t"), multi_path=True)
    due = fs.due_windows(together, F.to_timestamp(F.lit("2024-01-01 00:00:38")), 7)
    assert [len(r["files"]) for r in due.collect()] == [2]
    rolled = fs.batch_windows(files.where("url like '%x/2%'"), 10, F.lit("d.t"), roll_over=True).first()
    assert rolled["window_start"].second == 30
    half = files.where("url like '%x/1%'").withColumn("modified", F.to_timestamp(F.lit("2024-01-01 00:00:27")))
    assert fs.batch_windows(half, 10, F.lit("d.t"), roll_over=True).first()["window_start"].second == 10


def test_stream_to_tables(spark, db, tmp_path):
    garden(spark, f"{db}.t")
    put(tmp_path, "in/a.json", [GOOD])
    put(tmp_path, "in/b.json", [{**GOOD, "shelf": 9}])
    rule = R.parse({"When": {"Suffix": ".json"}, "Dest": {"Table": f"{db}.t"}, "Batch": {"Window": {"DurationInSec": 15}}})
    collect_manifest(spark, str(tmp_path / "in"), rule, f"{db}.manifest", str(tmp_path / "cp")).awaitTermination()
    journal = Journal(spark, f"{db}.journal")
    later = F.current_timestamp() + F.expr("interval 1 day")
    assert run_due(spark, rule, f"{db}.manifest", F.lit("1990-01-01").cast("timestamp"), journal) == []
    run_due(spark, rule, f"{db}.manifest", later, journal)
    assert sorted(r["shelf"] for r in spark.table(f"{db}.t").collect()) == [3, 9]
    put(tmp_path, "in/late.json", [{**GOOD, "shelf": 10}])
    collect_manifest(spark, str(tmp_path / "in"), rule, f"{db}.manifest", str(tmp_path / "cp")).awaitTermination()
    run_due(spark, rule, f"{db}.manifest", later, journal)
    run_due(spark, rule, f"{db}.manifest", later, journal)
    assert sorted(r["shelf"] for r in spark.table(f"{db}.t").collect()) == [3, 9, 10]
    assert fs.manifest(spark, str(tmp_path / "in")).count() == 3


def test_windowed_counts(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:09", "a"), ("2024-01-01 00:00:11", "b")], "at string, k string")
    got = windowed_counts(df.withColumn("at", F.to_timestamp("at")), "at", 10, 60, ["k"])
    assert sorted(r["count"] for r in got.collect()) == [1, 2]


def test_bad_record_options_reach_the_load(spark, db, tmp_path):
    """What a load allows is allowed by the sorting of files before it as well."""
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "shelf bigint, plant bigint, label string").schema)
    a = put(tmp_path, "in/a.csv", ["made by hand", "shelf|plant|label", "1|2|'x|y'", "3|4", "oops|5|z"])
    b = put(tmp_path, "in/b.csv", ["made by hand", "shelf|plant|label", "6|7|v", "no|8|w", "none|9|u"])
    dest = {"Table": f"{db}.t", "SourceFormat": "CSV", "FieldDelimiter": "|", "Quote": "'", "SkipLeadingRows": 2, "AllowJaggedRows": True}
    out = ingest(spark, R.parse({"Dest": {**dest, "MaxBadRecords": 1}}), [SourceFile(u, NOW) for u in (a, b)], "1")
    assert out.rows_from == [a] and out.corrupted + out.invalid_schema == [b]
    assert sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(1, 2, "x|y"), (3, 4, None)]
    strict = ingest(spark, R.parse({"Dest": {**dest, "AllowJaggedRows": False, "MaxBadRecords": 1}}), [SourceFile(a, NOW)], "2")
    assert strict.rows_from == []
    with pytest.raises(ValueError):
        fs.load(spark, [a], None, fs.LoadOptions("csv", skip_leading_rows=2))


def test_missing(spark, tmp_path):
    there = [put(tmp_path, f"in/{n}", [GOOD]) for n in ("a.json", "b b.json", "c.json")]
    gone = [str(tmp_path / "in" / "d.json"), str(tmp_path / "other" / "e.json")]
    assert recovery.missing(spark, [gone[0], *there, gone[1]]) == gone


def test_reload_ends(spark, db, tmp_path):
    garden(spark, f"{db}.t")
    good, bad = put(tmp_path, "a.json", [GOOD]), put(tmp_path, "b.json", ["{"])
    request = {"SourceURIs": [good, bad], "SourceFormat": "json", "Dest": f"{db}.t"}
    with pytest.raises(fs.TooManyBadRecords):
        run_actions([R.Action.load({"Action": "load", "Request": {**request, "MaxReload": 0}})], Context(spark))
    ctx = Context(spark)
    run_actions([R.Action.load({"Action": "load", "Request": request})], ctx)
    assert ctx.variables.values["Loaded"] == [good] and ctx.variables.values["Rejected"] == [bad]


def test_groups_of_several_runs(spark, db):
    from siltworks.plans.ingest import open_group

    ran, table = [], f"{db}.groups"
    open_group(Context(spark, group_table=table), "g", 2)
    action = lambda m: R.Action.load({"Action": "group", "Request": {"ID": "g", "Member": m}, "OnSuccess": [{"Action": "push"}]})
    for member in "aab":
        run_actions([action(member)], Context(spark, services={"push": lambda r: ran.append(member)}, group_table=table))
    assert ran == ["b"]


def test_assign_rules(spark):
    of = lambda name, prefix: R.parse({"When": {"Prefix": prefix}, "Dest": {"Table": "d.t"}}, name)
    files = spark.createDataFrame([("s3://k/a/1",), ("s3://k/b/1",), ("s3://k/c/1",)], "url string")
    got = {r["url"][-3:]: r["rule"] for r in R.assign_rules(files, [of("one", "/a"), of("two", "/b")]).collect()}
    assert got == {"a/1": "one", "b/1": "two", "c/1": None}
    with pytest.raises(Exception, match="several rules"):
        R.assign_rules(files, [of("one", "/a"), of("two", "/")]).collect()


def test_rule_from_any_store(spark, tmp_path):
    path = put(tmp_path, "rule.yaml", ["Dest:", "  Table: d.t", "OnSuccess:", "  - Action: query", "    Request:", f"      SQLURL: file://{tmp_path}/q.sql"])
    put(tmp_path, "q.sql", ["SELECT 1"])
    (rule,) = R.load_rules(f"file://{path}")
    assert rule.on_success[0].request["sql"].strip() == "SELECT 1"


def test_removed_and_look_back(spark):
    known, now = spark.createDataFrame([("a",), ("b",)], "url string"), F.to_timestamp(F.lit("2024-01-02 00:00:00"))
    assert [r[0] for r in fs.removed(known, spark.createDataFrame([("b",)], "url string")).collect()] == ["a"]
    since = lambda t: fs.look_back(spark.createDataFrame([(t,)], "m string").select(F.to_timestamp("m").alias("modified")), now, 3600).first()[0]
    assert since("2024-01-01 23:30:00").minute == 30 and since("2024-01-01 10:00:00").hour == 23


def test_a_batch_is_scanned_twice(spark, db, tmp_path):
    """Once to judge its files and once to publish them, whatever the number of tables."""
    publish.create(spark, f"{db}.t", spark.createDataFrame([], "shelf bigint, plant bigint, label string").schema)
    a, b = put(tmp_path, "in/a.json", [GOOD, {**GOOD, "shelf": 4}]), put(tmp_path, "in/b.json", ["{"])
    split = {"Mapping": [{"When": f"MOD(shelf, 2) = {k}", "Then": f"{db}.t{k}"} for k in (0, 1)]}
    rule = R.parse({"Dest": {"Table": f"{db}.t", "Transient": {"Dataset": "x"}, "Schema": {"Template": f"{db}.t", "Split": split}}})
    store = spark._jsparkSession.sharedState().statusStore()
    before = {e.executionId() for e in map(store.executionsList().apply, range(store.executionsList().size()))}
    ingest(spark, rule, [SourceFile(u, NOW) for u in (a, b)], "1")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    after = [e for e in map(store.executionsList().apply, range(store.executionsList().size())) if e.executionId() not in before]
    scans = sum(e.physicalPlanDescription().split("===")[0].count(str(tmp_path / "in")) > 0 or "in/a.json" in e.physicalPlanDescription() for e in after)
    assert scans == 2
    assert [spark.table(f"{db}.t{k}").first()["shelf"] for k in (0, 1)] == [4, 3]


def test_responses_beyond_a_page(spark, db):
    from siltworks.plans import ingest as run

    ctx = Context(spark)
    run_actions([R.Action.load(a) for a in (
        {"Action": "query", "Request": {"SQL": "SELECT id, id % 7 AS k FROM range(100000)"}},
        {"Action": "query", "Request": {"SQL": "SELECT k, COUNT(1) AS n FROM $RowsTable GROUP BY k", "Dest": f"{db}.sums"}},
    )], ctx)
    assert len(ctx.variables.values["Rows"]) == run.FETCHED
    assert spark.table(f"{db}.sums").groupBy().sum("n").first()[0] == 100_000
    sizes, ids = [], set()
    for page in run.pages(spark, ctx.variables.values["RowsTable"], 30_000):
        sizes.append(len(page))
        ids |= {r["id"] for r in page}
    assert sizes == [30_000, 30_000, 30_000, 10_000] and ids == set(range(100_000))
    publish.drop(spark, ctx.variables.values["RowsTable"])


def test_quoted_breaks_over_blocks(spark, tmp_path):
    """Leading rows and quoted breaks together, in a file of many blocks, as one reader takes it whole."""
    rng = __import__("random").Random(6)
    rows = [(k, rng.choice(["plain", 'a "quoted" word', "two\nlines", "\n\nblank ones\n", "x,y", ""]) + "." * rng.randint(0, 30)) for k in range(2_000)]
    quote = lambda t: '"' + t.replace('"', '""') + '"'
    head = 'made by\n"a report\nof two lines"\nn,t\n'
    (tmp_path / "a.csv").write_text(head + "".join(f"{n},{quote(t)}\n" for n, t in rows))
    (tmp_path / "b.csv").write_text('h1\nh2\nh3\n-1,"one\nmore"\n\n-2,last')
    schema = spark.createDataFrame([], "n long, t string").schema
    options = fs.LoadOptions("csv", skip_leading_rows=3, options={"AllowQuotedNewlines": "true", "escape": '"'})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1kb", "7kb", "128mb"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = fs.load(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], schema, options)
            assert size != "1kb" or spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20
            got = sorted(map(tuple, read.fillna("", ["t"]).collect()))
            assert got == sorted([*rows, (-1, "one\nmore"), (-2, "last")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_leading_rows_over_blocks(spark, tmp_path):
    """Leading rows end in any block of a file; lines behind them are neither shuffled nor put in order."""
    (tmp_path / "a.csv").write_text("made by\n" + "x" * 3_000 + "\nn,t\n" + "".join(f"{n},t{n}\n\n" for n in range(2_000)))
    (tmp_path / "b.csv").write_text("h1\nh2\n")
    (tmp_path / "c.csv").write_text("h1\nh2\nh3\n-1,last")
    schema, urls = spark.createDataFrame([], "n long, t string").schema, [str(tmp_path / f"{n}.csv") for n in "abc"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1kb", "7kb", "128mb"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = fs.load(spark, urls, schema, fs.LoadOptions("csv", skip_leading_rows=3))
            assert sorted(map(tuple, read.collect())) == [(-1, "last"), *((n, f"t{n}") for n in range(2_000))]
            # what is shuffled is counts of blocks
            plan = read._jdf.queryExecution().optimizedPlan().toString()
            assert "_lines" in plan and not any("_n#" in line for line in plan.splitlines() if "Window" in line)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stretches_of_a_block(spark, tmp_path, monkeypatch):
    """A record may span stretches of a block as it may span blocks, and none is put in order whole."""
    monkeypatch.setattr(fs, "STRETCH", 7, raising=True)
    rows = [(k, "two\nlines" if k % 3 else "three\n\nlines") for k in range(500)]
    (tmp_path / "a.csv").write_text('by\n"us\ntoo"\n' + "".join(f'{n},"{t}"\n' for n, t in rows))
    schema = spark.createDataFrame([], "n long, t string").schema
    read = fs.load(spark, [str(tmp_path / "a.csv")], schema, fs.LoadOptions("csv", skip_leading_rows=2, options={"AllowQuotedNewlines": "true"}))
    assert sorted(map(tuple, read.collect())) == rows


def test_files_behind_leading_rows(spark, tmp_path):
    """Every file has the leading rows, and no task has the rows of all."""
    from siltworks.plans.run_queries import write_behind

    write_behind(spark.range(100, numPartitions=3).selectExpr("if(id = 0, null, cast(id as string)) value"), "h1\nh2", str(tmp_path / "in"))
    files = [p.read_text().split("\n") for p in (tmp_path / "in").glob("*.txt")]
    assert len(files) == 3 and all(lines[:2] == ["h1", "h2"] for lines in files)
    assert sorted(v for lines in files for v in lines[2:] if v) == sorted(map(str, range(1, 100)))
