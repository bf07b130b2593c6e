"""Registered queries that run rules, actions, loads and names end to end; SQL gives the same rows."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import datetime, timedelta, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import naming
from siltworks.functions.dialect import to_spark
from siltworks.operators import monitor, publish
from siltworks.plans import ingest as run
from siltworks.plans import rule as rules
from siltworks.plans.queries import pseudo_files, scratch, table
from siltworks.sources import files as fs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str):
    def put(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return put


def folder(spark: SparkSession) -> tuple[str, str]:
    """A new database and the folder of its files, for one query."""
    db = scratch(spark)
    return db, spark.sql(f"DESCRIBE SCHEMA {db}").where("info_name = 'Location'").first()["info_value"]


def files_in(spark: SparkSession, url: str, pattern: str = "*.json") -> list[naming.SourceFile]:
    rows = fs.manifest(spark, url, pattern).orderBy("url").collect()
    return [naming.SourceFile(r["url"], r["modified"].astimezone(timezone.utc)) for r in rows]


def region_files(spark: SparkSession, d: str, url: str) -> None:
    """One JSON file for each region, in a folder of its key."""
    region = table(spark, d, "region").select("r_regionkey", "r_name", F.col("r_regionkey").alias("k"))
    region.repartition(1).write.partitionBy("k").json(url)


def write_behind(rows: DataFrame, head: str, url: str) -> None:
    """The column value in text files behind these leading rows: each task writes a file, and its first row takes them along."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows.select(F.when(first, F.concat(F.lit(f"{head}\n"), F.coalesce("value", F.lit("")))).otherwise(F.col("value")).alias("value")).write.text(url)


# --- sources -----------------------------------------------------------------------------------


@register("multi_uri_load", "SELECT r_regionkey, r_name FROM region")
def multi_uri_load(spark, d):
    _, at = folder(spark)
    region_files(spark, d, f"{at}/in")
    urls = [f.url for f in files_in(spark, f"{at}/in")]
    return fs.load(spark, urls + urls[:2], table(spark, d, "region").select("r_regionkey", "r_name").schema)


@register("recursive_manifest", "SELECT r_regionkey AS k, 1::BIGINT AS n_files FROM region")
def recursive_manifest(spark, d):
    _, at = folder(spark)
    region_files(spark, d, f"{at}/in/deep")
    found = fs.manifest(spark, f"{at}/in", "*.json")
    return found.groupBy(F.regexp_extract("url", r"/k=(\d+)/", 1).cast("long").alias("k")).agg(F.count("*").alias("n_files"))


@register("settled_files", "SELECT event_id FROM events WHERE epoch_us(ts) < (SELECT epoch_us(MAX(ts)) FROM events) - 3600000000")
def settled_files(spark, d):
    files = pseudo_files(spark, d)
    now = files.agg(F.max("modified")).first()[0]
    return fs.settled(files, F.lit(now), 3600).select("event_id")


@register("newest_files", "SELECT event_id FROM events ORDER BY ts DESC, 's3://lake/data/' || event_type || '/u' || user_id % 10 || '/' || event_id || '.json' LIMIT 100")
def newest_files(spark, d):
    return fs.newest_first(pseudo_files(spark, d)).limit(100).select("event_id")


@register("look_back", "SELECT greatest(MIN(epoch_us(ts)), MAX(epoch_us(ts)) - 86400000000) // 1000000 AS since FROM events")
def look_back(spark, d):
    files = pseudo_files(spark, d)
    now = files.agg(F.max("modified")).first()[0]
    return fs.look_back(files, F.lit(now), 86_400).select(F.unix_timestamp(F.col("since").cast("timestamp")).alias("since"))


@register("removed_rules", "SELECT DISTINCT doc_id AS url FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def removed_rules(spark, d):
    known = table(spark, d, "labels").select(F.col("doc_id").alias("url")).distinct()
    return fs.removed(known, table(spark, d, "documents").where("n_chars > 500").select(F.col("doc_id").alias("url")))


@register(
    "bad_record_options",
    """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT r_regionkey, 'r', NULL FROM region WHERE r_regionkey > 0
    """,
)
def bad_record_options(spark, d):
    """CSV files of two header lines, a delimiter that patterns know, short rows and a bad row in one of them."""
    _, at = folder(spark)
    orders = table(spark, d, "orders")
    price = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("|"), F.col("o_totalprice").cast("string")))
    body = orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("|"), "o_orderstatus", F.coalesce(price, F.lit(""))).alias("value"))
    small = table(spark, d, "region").select(F.when(F.col("r_regionkey") == 0, "not a number|r|0").otherwise(F.concat(F.col("r_regionkey").cast("string"), F.lit("|r"))).alias("value"))
    for name, rows in (("orders", body), ("region", small)):
        write_behind(rows, "made by a report\no_orderkey|o_orderstatus|o_totalprice", f"{at}/in/{name}")
    schema = orders.select("o_orderkey", "o_orderstatus", "o_totalprice").schema
    dest = f"{at.rpartition('/')[2].removesuffix('.db')}.out"
    publish.create(spark, dest, schema)
    rule = rules.parse({"When": {"Prefix": "/"}, "Dest": {"Table": dest, "SourceFormat": "CSV", "FieldDelimiter": "|", "SkipLeadingRows": 2, "MaxBadRecords": 1, "AllowJaggedRows": True}})
    run.ingest(spark, rule, files_in(spark, f"{at}/in", "*.txt"), "e1")
    return spark.table(dest)


# --- rules, windows, names ---------------------------------------------------------------------


@register("rule_selection", "SELECT event_id, CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' END AS rule FROM events")
def rule_selection(spark, d):
    found = [rules.parse({"When": {"Prefix": f"/data/{k}/", "Suffix": ".json"}, "Dest": {"Table": f"lake.{k}"}}, f"{k}s") for k in ("click", "view")]
    return rules.assign_rules(pseudo_files(spark, d), found).select("event_id", "rule")


@register(
    "roll_over_windows",
    """
    WITH f AS (
        SELECT event_id, event_type || '/' || user_id % 10 AS grp, epoch_us(ts) AS us, epoch_us(ts) // 1000000 - epoch_us(ts) // 1000000 % 95 AS lo FROM events
    ), w AS (SELECT grp, lo, MIN(us) AS first FROM f GROUP BY 1, 2)
    SELECT event_id, CAST(CASE WHEN p.lo IS NULL AND w.first >= w.lo * 1000000 + 47500000 THEN f.lo - 95 ELSE f.lo END AS BIGINT) AS start_sec, CAST(f.lo + 95 AS BIGINT) AS end_sec
    FROM f JOIN w USING (grp, lo) LEFT JOIN w p ON p.grp = f.grp AND p.lo = f.lo - 95
    """,
)
def roll_over_windows(spark, d):
    w = fs.batch_windows(pseudo_files(spark, d), 95, F.lit("lake.events"), roll_over=True)
    at = lambda c: F.unix_timestamp(F.to_timestamp(c)).cast("long")
    return w.select("event_id", at("window_start").alias("start_sec"), at("window_end").alias("end_sec"))


@register(
    "pattern_hash_groups",
    "SELECT event_type, CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 86400 + 86400 AS end_sec, COUNT(*) AS n_files FROM events GROUP BY 1, 2",
)
def pattern_hash_groups(spark, d):
    files = pseudo_files(spark, d).withColumn("event_type", F.regexp_extract("url", r"/data/([^/]+)/", 1))
    w = fs.batch_windows(files, 86_400, F.lit("lake.events"), multi_path=True, pattern=r"/data/([^/]+)/u\d", suffix=".json")
    out = w.groupBy("group", "window_end").agg(F.min("event_type").alias("event_type"), F.count("*").alias("n_files"))
    return out.select("event_type", F.unix_timestamp(F.to_timestamp("window_end")).cast("long").alias("end_sec"), "n_files")


@register(
    "rule_destinations",
    "SELECT event_id, 'lake.t_' || event_type || '_' || strftime(ts, '%Y%m%d') || '_' || replace(upper(event_type), 'I', 'X') AS dest FROM events",
)
def rule_destinations(spark, d):
    """The destination table of each file, with its date, pattern groups and named parameters."""
    rule = rules.parse({"When": {"Prefix": "/data/"}, "Dest": {"Table": "p:lake.t_$1_$Date_$Kind", "Pattern": "/data/([^/]+)/", "Parameters": [{"Name": "Kind", "Expression": "$Replace($ToUpper($1), 'I', 'X')"}]}})

    dest = naming.table_name(rule.destinations(F.col("url"), F.col("modified")))
    return pseudo_files(spark, d).select("event_id", dest.alias("dest"))


@register(
    "activity_names",
    "SELECT event_id, 'lake.events/' || user_id || '_' || lpad(CAST(event_id % 99999 AS VARCHAR), 5, '0') || '_' || event_type || '--dispatch' AS id, 'lake.events' AS tab, CAST(user_id AS VARCHAR) AS event, CAST(event_id % 99999 AS INTEGER) AS step, event_type AS action, 'dispatch' AS mode FROM events",
)
def activity_names(spark, d):
    step = F.col("event_id")
    ids = table(spark, d, "events").select("event_id", naming.activity_ids(F.lit("lake.events"), F.col("user_id").cast("string"), step, F.col("event_type"), F.lit("dispatch")).alias("id"))
    parts = naming.activity_parts(F.col("id"))
    return ids.select("event_id", "id", parts["table"].alias("tab"), parts["event_id"].alias("event"), parts["step"].alias("step"), parts["action"].alias("action"), parts["mode"].alias("mode"))


@register("window_files", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(epoch_us(ts) // 1000000 AS BIGINT) END AS end_sec FROM events")
def window_files(spark, d):
    end = F.unix_timestamp(F.col("ts").cast("timestamp"))
    name = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("s3://ops/lake.events_"), end, F.lit(".win"))).otherwise(F.lit("s3://ops/lake.events.loc"))
    return table(spark, d, "events").select("event_id", naming.window_file_end(name).alias("end_sec"))


@register("history_names", "SELECT page_id, replace(to_base64(unhex(md5(url))), '=', '') || '.json' AS history FROM pages")
def history_names(spark, d):
    return table(spark, d, "pages").select("page_id", naming.history_name(F.col("url")).alias("history"))


# --- SQL of rules ------------------------------------------------------------------------------


@register("unnest_sql", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def unnest_sql(spark, d):
    view = f"nested_{uuid.uuid4().hex[:8]}"
    table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice", "o_orderstatus")).alias("items")).createOrReplaceTempView(view)
    return publish.query(spark, f"SELECT t.o_custkey, i.o_orderkey, i.o_totalprice FROM {view} t, UNNEST(t.items) AS i WHERE i.o_orderstatus = 'F'")


@register("dialect_sql", "SELECT n_nationkey, n_name || '!' AS tagged, upper(n_name)[1] AS head, '[p:a.b] TIMESTAMP(NULL)' AS text, CAST(NULL AS BIGINT) AS nothing, 2030 > 2020 AS later FROM nation WHERE regexp_matches(n_name, '[A-Z.0-9]')")
def dialect_sql(spark, d):
    """A table in brackets, one in backticks, an index, a pattern and a text that look like them, a typed null."""
    db = scratch(spark)
    publish.write(table(spark, d, "nation"), f"{db}.nation")
    sql = (
        "SELECT t.n_nationkey, concat(t.n_name, '!') AS tagged, split(upper(u.n_name), '')[t.n_nationkey - u.n_nationkey] AS head, '[p:a.b] TIMESTAMP(NULL)' AS text, INT64(NULL) AS nothing, CURRENT_DATE() > DATE '2020-01-01' AS later"
        f" FROM [proj:{db}.nation] t JOIN `proj.{db}.nation` u ON t.n_nationkey = u.n_nationkey WHERE t.n_name RLIKE '[A-Z.0-9]'"
    )
    return spark.sql(to_spark(sql))


# --- actions -----------------------------------------------------------------------------------


def act(spark: SparkSession, *actions: dict, **more) -> run.Context:
    ctx = run.Context(spark, naming.Variables(more.pop("values", {})), **more)
    run.run_actions([rules.Action.load(a) for a in actions], ctx)
    return ctx


@register("action_insert_drop", "SELECT r_regionkey, r_name, false AS gone FROM region UNION ALL SELECT 100, 'added', false")
def action_insert_drop(spark, d):
    db = scratch(spark)
    publish.write(table(spark, d, "region").where("r_regionkey < 2").select("r_regionkey", "r_name"), f"{db}.out")
    publish.write(table(spark, d, "region").where("r_regionkey >= 2").select("r_regionkey", "r_name"), f"{db}.more")
    ctx = act(
        spark,
        {"Action": "insert", "Request": {"SQL": f"SELECT * FROM {db}.more", "Dest": f"{db}.out"}},
        {"Action": "insert", "Request": {"Rows": [{"r_regionkey": 100, "r_name": "added"}], "Dest": f"{db}.out"}},
        {"Action": "drop", "Request": {"Table": f"{db}.more"}},
        {"Action": "tableExists", "Request": {"Table": f"{db}.more"}},
    )
    return spark.table(f"{db}.out").withColumn("gone", F.lit(ctx.variables.values["Exists"]))


@register("action_when_exists", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def action_when_exists(spark, d):
    db = scratch(spark)
    publish.write(table(spark, d, "nation"), f"{db}.nation")
    copy = lambda when, key: {"Action": "query", "When": {"Exists": f"{db}.{when}"}, "Request": {"SQL": f"SELECT n_nationkey, n_name FROM {db}.nation WHERE n_regionkey = {key}", "Dest": f"{db}.out", "Append": True}}
    act(spark, copy("nation", 1), copy("absent", 2))
    return spark.table(f"{db}.out")


@register("action_query_rows", "SELECT n_regionkey, COUNT(*) AS n FROM nation GROUP BY 1")
def action_query_rows(spark, d):
    """All rows of a query without a destination come back as the action's response."""
    db = scratch(spark)
    publish.write(table(spark, d, "nation"), f"{db}.nation")
    ctx = act(spark, {"Action": "query", "Request": {"SQL": f"SELECT n_regionkey, COUNT(1) AS n FROM {db}.nation GROUP BY 1"}})
    return spark.createDataFrame(ctx.variables.values["Rows"], "n_regionkey long, n long")


@register("action_move_delete", "SELECT r_regionkey, CASE WHEN r_regionkey < 2 THEN 'done' ELSE 'in' END AS place FROM region WHERE r_regionkey <> 4")
def action_move_delete(spark, d):
    _, at = folder(spark)
    region_files(spark, d, f"{at}/in")
    urls = {int(f.url.partition("/k=")[2].partition("/")[0]): f.url for f in files_in(spark, f"{at}/in")}
    act(spark, *[{"Action": "move", "Request": {"URLs": urls[k], "DestURL": f"{at}/done/k={k}"}} for k in (0, 1)], {"Action": "delete", "Request": {"URLs": urls[4]}})
    rows = [spark.read.schema("r_regionkey long").json(f"{at}/{p}", recursiveFileLookup=True).withColumn("place", F.lit(p)) for p in ("in", "done")]
    return rows[0].union(rows[1])


@register("action_services", "SELECT k AS service, n_name AS nation, COUNT(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey, (VALUES ('call'), ('notify'), ('push')) v(k) WHERE n_regionkey = 1 GROUP BY 1, 2")
def action_services(spark, d):
    """Each service is told what a query before it has found, row by row of its response."""
    db, sent = scratch(spark), []
    for name in ("nation", "customer"):
        publish.write(table(spark, d, name), f"{db}.{name}")
    services = {k: (lambda r, k=k: sent.extend((k, x["n_name"], x["n"]) for x in r["rows"])) for k in ("notify", "call", "push")}
    sql = f"SELECT n_name, COUNT(1) AS n FROM {db}.nation JOIN {db}.customer ON c_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY n_name"
    act(spark, {"Action": "query", "Request": {"SQL": sql}}, *[{"Action": k, "Request": {"Rows": "$Rows"}} for k in services], services=services)
    return spark.createDataFrame(sent, "service string, nation string, n long")


@register("action_reload", "SELECT r_regionkey, r_name FROM region WHERE r_regionkey <> 3")
def action_reload(spark, d):
    """A load of five files, one of them corrupt and one that isn't there, comes down to the good ones."""
    db, at = folder(spark)
    region_files(spark, d, f"{at}/in")
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.text(f"{at}/bad")
    publish.create(spark, f"{db}.region", table(spark, d, "region").select("r_regionkey", "r_name").schema)
    urls = [f.url for f in files_in(spark, f"{at}/in") if "/k=3/" not in f.url] + [f.url for f in files_in(spark, f"{at}/bad", "*.txt")] + [f"{at}/absent.json"]
    act(spark, {"Action": "load", "Request": {"SourceURIs": urls, "SourceFormat": "NEWLINE_DELIMITED_JSON", "Dest": f"{db}.region", "MaxReload": 2}})
    return spark.table(f"{db}.region")


@register("batch_groups", "SELECT n_regionkey AS grp, MAX(n_nationkey) AS last_member, COUNT(*) AS members FROM nation GROUP BY 1")
def batch_groups(spark, d):
    """A group for each region: its nations report from contexts of their own, some twice; the last lets the group's query run."""
    db = scratch(spark)
    publish.write(table(spark, d, "nation").select("n_nationkey", "n_regionkey"), f"{db}.nation")
    publish.create(spark, f"{db}.done", table(spark, d, "nation").selectExpr("n_regionkey AS grp", "n_nationkey AS last_member", "count(1) over () AS members").schema)
    sizes = spark.table(f"{db}.nation").groupBy("n_regionkey").count().collect()
    for r in sizes:
        run.open_group(run.Context(spark, group_table=f"{db}.groups"), str(r[0]), r[1])
    for n in spark.table(f"{db}.nation").orderBy("n_nationkey").collect():
        sql = f"INSERT INTO {db}.done SELECT n_regionkey, {n[0]}, COUNT(1) FROM {db}.nation WHERE n_regionkey = {n[1]} GROUP BY 1"
        group = {"Action": "group", "Request": {"ID": str(n[1]), "Member": str(n[0])}, "OnSuccess": [{"Action": "query", "Request": {"SQL": sql}}]}
        for _ in range(2 if n[0] % 12 == 0 else 1):
            act(spark, group, group_table=f"{db}.groups")
    return spark.table(f"{db}.done")


@register("journal_replay", "SELECT event_id, event_type AS dest FROM events WHERE user_id % 5 = 0 AND event_id % 3 < 2")
def journal_replay(spark, d):
    """Runs that began and neither ended nor failed, of a journal with up to three states an event."""
    journal = run.Journal(spark, f"{scratch(spark)}.journal")
    events = table(spark, d, "events").where("user_id % 5 = 0").withColumn("at", F.col("ts").cast("timestamp"))
    states = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("running"))).when(F.col("event_id") % 3 == 1, F.array(F.lit("failed"), F.lit("running"), F.lit("published"))).otherwise(F.array(F.lit("running"), F.lit("done")))
    rows = events.select(F.col("event_id").cast("string").alias("event_id"), F.lit("r").alias("rule"), F.col("event_type").alias("dest"), F.posexplode(states).alias("n", "state"), "at")
    put = rows.select("event_id", "rule", "dest", "state", F.array(F.concat(F.lit("s3://x/"), "event_id")).alias("urls"), (F.col("at") + F.make_dt_interval(secs=F.col("n"))).alias("at"), F.lit(None).cast("string").alias("error"))
    put.repartition(24).write.insertInto(journal.table)
    journal.most = 8
    journal.compact()
    return journal.replay(datetime.now(timezone.utc) + timedelta(seconds=1)).select(F.col("event_id").cast("long").alias("event_id"), "dest")


# --- tables ------------------------------------------------------------------------------------


@register("template_patch_nested", "SELECT s_suppkey, s_name AS name, CAST(NULL AS BIGINT) AS rank FROM supplier UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 2 = 0")
def template_patch_nested(spark, d):
    db = scratch(spark)
    rows = table(spark, d, "supplier")
    publish.write(rows.select("s_suppkey", F.struct(F.col("s_name").alias("name")).alias("meta")), f"{db}.supplier")
    more = rows.where("s_suppkey % 2 = 0").select("s_suppkey", F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").cast("long").alias("rank")).alias("meta"))
    publish.patch(spark, f"{db}.supplier", more.schema)
    publish.write(more, f"{db}.supplier")
    return spark.table(f"{db}.supplier").select("s_suppkey", "meta.name", "meta.rank")


@register("expiry_sweep", "SELECT c_mktsegment AS segment, COUNT(*) AS n FROM customer GROUP BY 1 HAVING MAX(c_custkey) % 2 = 1 OR COUNT(*) % 3 = 0")
def expiry_sweep(spark, d):
    """A table for each segment, with a time to go that its rows decide; those that stay are read."""
    db, now = scratch(spark), datetime.now(timezone.utc)
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    segments = customers.groupBy("c_mktsegment").agg(F.max("c_custkey").alias("most"), F.count("*").alias("n")).orderBy("c_mktsegment").collect()
    publish.write_split(customers, [(f"c_mktsegment = '{r[0]}'", f"{db}.s{k}") for k, r in enumerate(segments)])
    for k, r in enumerate(segments):
        stays = r["most"] % 2 == 1 or r["n"] % 3 == 0
        publish.set_expiry(spark, f"{db}.s{k}", 60, now if stays else now - timedelta(hours=1))
    gone = set(publish.sweep(spark, db, now))
    left = [spark.table(f"{db}.s{k}") for k in range(len(segments)) if f"{db}.s{k}" not in gone]
    rows = reduce(DataFrame.union, left) if left else customers.limit(0)
    return rows.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))


@register("copy_with_template", "SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS score FROM customer")
def copy_with_template(spark, d):
    db = scratch(spark)
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    publish.write(rows, f"{db}.source")
    publish.create(spark, f"{db}.template", publish.optional(rows.withColumn("score", F.lit(0.0)).schema))
    publish.copy(spark, f"{db}.source", f"{db}.dest", template=f"{db}.template")
    return spark.table(f"{db}.dest")


@register("copy_partitions_sql", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')")
def copy_partitions_sql(spark, d):
    db = scratch(spark)
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    publish.create(spark, f"{db}.orders", rows.schema, ["o_orderstatus"])
    publish.write(rows, f"{db}.orders")
    act(spark, {"Action": "copy", "Request": {"Source": f"{db}.orders", "Dest": f"{db}.copied", "PartitionSQL": "SELECT DISTINCT o_orderstatus AS partition_id FROM ${Source.DatasetID}.${Source.TableID} WHERE o_orderstatus <> 'P'"}})
    return spark.table(f"{db}.copied")


@register("staged_split", "SELECT event_id, user_id, CAST(ts AS DATE) AS day, user_id % 2 = 0 AS even FROM events")
def staged_split(spark, d):
    """A split over a staged table in partitions of days, its rows clustered, read once for each destination."""
    db = scratch(spark)
    events = table(spark, d, "events").select("event_id", F.struct("user_id").alias("who"), F.col("ts").cast("timestamp").alias("ts"))
    staged = publish.stage_split(events, f"{db}.staged", ["who.user_id"], "ts")
    publish.write_split(staged, [("MOD(user_id, 2) = 0", f"{db}.even"), ("MOD(user_id, 2) = 1", f"{db}.odd")])
    read = lambda n: spark.table(f"{db}.{n}").select("event_id", "user_id", F.to_date("ts").alias("day"), F.lit(n == "even").alias("even"))
    return read("even").union(read("odd"))


# --- monitoring and streams --------------------------------------------------------------------


@register("recent_events", "SELECT event_id FROM events WHERE epoch_us(ts) >= (SELECT epoch_us(MAX(ts)) FROM events) - 7200000000")
def recent_events(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    now = events.agg(F.max("ts")).first()[0]
    return monitor.recent(events, "ts", F.lit(now), 7200).select("event_id")


@register("long_running", "SELECT event_id FROM events WHERE epoch_us(ts) // 1000000 < (SELECT epoch_us(MAX(ts)) // 1000000 FROM events) - 5400 ORDER BY ts, event_id LIMIT 100")
def long_running(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("started"))
    now = events.agg(F.max("started")).first()[0]
    return monitor.long_running(events, F.lit(now), 5400).select("event_id")


@register("stream_ingest", "SELECT r_regionkey, r_name FROM region")
def stream_ingest(spark, d):
    """Files through a stream's manifest into closed windows and a table; one file comes late, all count once."""
    from siltworks.streaming.ingest import collect_manifest, run_due

    db, at = folder(spark)
    region = table(spark, d, "region").select("r_regionkey", "r_name", F.col("r_regionkey").alias("k"))
    publish.create(spark, f"{db}.region", region.drop("k").schema)
    rule = rules.parse({"When": {"Prefix": "/", "Suffix": ".json"}, "Dest": {"Table": f"{db}.region"}, "Batch": {"Window": {"DurationInSec": 10}, "MultiPath": True}})
    journal, later = run.Journal(spark, f"{db}.journal"), F.current_timestamp() + F.expr("interval 1 hour")
    for part in ("k < 4", "k = 4", "k > 4"):
        region.where(part).repartition(1).write.mode("append").partitionBy("k").json(f"{at}/in")
        collect_manifest(spark, f"{at}/in", rule, f"{db}.manifest", f"{at}/state").awaitTermination()
        run_due(spark, rule, f"{db}.manifest", later, journal)
    return spark.table(f"{db}.region")


@register("windowed_counts", "SELECT epoch_us(ts) // 1000000 // 600 * 600 AS start_sec, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    """Counts by tumbling window of a stream of event files, once all of them are there, under a watermark."""
    from siltworks.streaming.ingest import windowed_counts as counts

    db, at = folder(spark)
    events = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    events.repartition(3).write.parquet(f"{at}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{at}/in")
    sink = f"counts_{uuid.uuid4().hex[:8]}"
    query = counts(stream, "at", 600, 3600, ["event_type"]).writeStream.format("memory").queryName(sink).outputMode("complete").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(sink).select(F.unix_timestamp("window_start").alias("start_sec"), "event_type", F.col("count").alias("n"))


@register("rules_by_table", "SELECT event_id, event_type AS rule FROM events WHERE event_type IN ('click', 'view')")
def rules_by_table(spark, d):
    """Files that the rules of one table take, of rules for every kind of event; a split counts by its tables."""
    kinds = [r[0] for r in table(spark, d, "events").select("event_type").distinct().orderBy("event_type").collect()]
    split = {"Split": {"Mapping": [{"When": "v > 0", "Then": "lake.clicks_and_views"}]}}
    wide = lambda k: {"Table": f"lake.{k}", "Transient": {"Dataset": "t"}, "Schema": split}
    found = [rules.parse({"When": {"Prefix": f"/data/{k}/"}, "Dest": {"Table": "p:lake.clicks_and_views"} if k == "click" else wide(k) if k == "view" else {"Table": f"lake.{k}"}}, k) for k in kinds]
    return rules.assign_rules(pseudo_files(spark, d), rules.rules_for_table(found, "clicks_and_views")).where("rule is not null").select("event_id", "rule")


# --- changes as a whole -------------------------------------------------------------------------


@register(
    "merge_upsert",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 15 <> 5
    UNION ALL SELECT -o_orderkey - 1, o_totalprice, 'N' FROM orders WHERE o_orderkey % 100 = 0
    """,
)
def merge_upsert(spark, d):
    """New prices for a third of the orders, some of them gone, and orders that are new, in one MERGE."""
    db = scratch(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    publish.create(spark, f"{db}.orders", orders.schema, ["o_orderstatus"])
    publish.write(orders, f"{db}.orders")
    given = orders.where("o_orderkey % 3 = 0 or o_orderkey % 15 = 5").select("o_orderkey", F.expr("if(o_orderkey % 3 = 0, o_totalprice + 1, NULL)").alias("price"))
    new = orders.where("o_orderkey % 100 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_totalprice").alias("price"))
    publish.write(given.union(new), f"{db}.given")
    sql = (
        f"MERGE INTO {db}.orders AS t USING {db}.given AS s ON t.o_orderkey = s.o_orderkey WHEN MATCHED AND s.price IS NULL THEN DELETE"
        " WHEN MATCHED THEN UPDATE SET o_totalprice = s.price WHEN NOT MATCHED THEN INSERT (o_orderkey, o_totalprice, o_orderstatus) VALUES (s.o_orderkey, s.price, 'N')"
    )
    act(spark, {"Action": "query", "Request": {"SQL": sql}})
    return spark.table(f"{db}.orders")


@register("delete_rows", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN l_quantity - 40 ELSE l_quantity END AS l_quantity, l_returnflag FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_discount > 0.05)")
def delete_rows(spark, d):
    db = scratch(spark)
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    publish.create(spark, f"{db}.lines", lines.schema, ["l_returnflag"])
    publish.write(lines, f"{db}.lines")
    for sql in (f"DELETE FROM {db}.lines WHERE l_returnflag = 'R' AND l_discount > 0.05", f"UPDATE {db}.lines SET l_quantity = l_quantity - 40 WHERE l_quantity > 40"):
        act(spark, {"Action": "query", "Request": {"SQL": sql}})
    return spark.table(f"{db}.lines").drop("l_discount")


@register(
    "published_once",
    "SELECT o_orderkey, 'even' AS half FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'odd' FROM orders WHERE o_orderkey % 2 = 1",
)
def published_once(spark, d):
    """A split whose action fails after it is published, and a second run of the event: every row is there once."""
    db, at = folder(spark)
    orders = table(spark, d, "orders").select("o_orderkey")
    orders.write.json(f"{at}/in")
    publish.create(spark, f"{db}.orders", orders.schema)
    split = {"Mapping": [{"When": f"MOD(o_orderkey, 2) = {k}", "Then": f"{db}.{n}"} for k, n in enumerate(("even", "odd"))]}
    rule = rules.parse({"Dest": {"Table": f"{db}.orders", "Transient": {"Dataset": "t"}, "Schema": {"Template": f"{db}.orders", "Split": split}}, "OnSuccess": [{"Action": "call", "Request": {}}]})
    files, journal, calls = files_in(spark, f"{at}/in"), run.Journal(spark, f"{db}.journal"), []

    def service(_):
        calls.append(1)
        if len(calls) == 1:
            raise ConnectionError("no answer")

    with suppress(ConnectionError):
        run.ingest(spark, rule, files, "e", journal, run.Context(spark, services={"call": service}))
    run.ingest(spark, rule, files, "e", journal, run.Context(spark, services={"call": service}))
    return reduce(DataFrame.union, [spark.table(f"{db}.{n}").withColumn("half", F.lit(n)) for n in ("even", "odd")])


@register(
    "parquet_field_addition",
    """
    SELECT c_custkey, c_name, CASE WHEN c_nationkey < 12 THEN c_nationkey END AS nation, CASE WHEN c_nationkey < 12 THEN c_acctbal END AS balance
    FROM customer WHERE c_nationkey < 20
    """,
)
def parquet_field_addition(spark, d):
    """Files with more columns, with fewer, and with a column of a type that doesn't fit, which alone stays out."""
    db, at = folder(spark)
    rows = table(spark, d, "customer")
    publish.create(spark, f"{db}.customer", T._parse_datatype_string("c_custkey bigint, c_name string, nation bigint"))
    rows.where("c_nationkey < 12").select("c_custkey", "c_name", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")).write.parquet(f"{at}/in/more")
    rows.where("c_nationkey between 12 and 19").select("c_custkey", "c_name").write.parquet(f"{at}/in/fewer")
    rows.where("c_nationkey >= 20").select("c_custkey", "c_name", F.lit("x").alias("nation")).write.parquet(f"{at}/in/unfit")
    rule = rules.parse({"Dest": {"Table": f"{db}.customer", "SourceFormat": "PARQUET", "AllowFieldAddition": True}})
    run.ingest(spark, rule, files_in(spark, f"{at}/in", "*.parquet"), "e")
    return spark.table(f"{db}.customer")


@register("csv_quoted_leading", "SELECT page_id, url, html FROM pages WHERE html NOT LIKE '%' || chr(13) || '%' AND html NOT LIKE '%\\%'")
def csv_quoted_leading(spark, d):
    """Whole pages, with their breaks and quotes, in CSV files behind three leading rows, one of them of two lines."""
    db, at = folder(spark)
    pages = table(spark, d, "pages").select("page_id", "url", "html").where("html NOT LIKE '%\r%' AND NOT contains(html, '\\\\')")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("page_id").cast("string"), quoted(F.col("url")), quoted(F.col("html")))
    for k in range(2):
        body = pages.where(F.col("page_id") % 2 == k).select(line.alias("value"))
        write_behind(body, 'made by\n"a report\nof two lines"\npage_id,url,html', f"{at}/in/{k}")
    publish.create(spark, f"{db}.pages", pages.schema)
    rule = rules.parse({"Dest": {"Table": f"{db}.pages", "SourceFormat": "CSV", "SkipLeadingRows": 3, "AllowQuotedNewlines": True}})
    rule.options.options["escape"] = '"'
    run.ingest(spark, rule, files_in(spark, f"{at}/in", "*.txt"), "e")
    return spark.table(f"{db}.pages")


def _two_loads(spark, d) -> run.Journal:
    """Nations by region with a corrupt file beside them, and suppliers, each one event of a journal."""
    db, at = folder(spark)
    journal = run.Journal(spark, f"{db}.journal")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("k"))
    nation.repartition(1).write.partitionBy("k").json(f"{at}/in/nation")
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.text(f"{at}/in/bad")
    table(spark, d, "supplier").select("s_suppkey", "s_name").repartition(2).write.json(f"{at}/in/supplier")
    files = {"nation": files_in(spark, f"{at}/in/nation") + files_in(spark, f"{at}/in/bad", "*.txt"), "supplier": files_in(spark, f"{at}/in/supplier")}
    for name, columns in (("nation", "n_nationkey int, n_name string"), ("supplier", "s_suppkey bigint, s_name string")):
        publish.create(spark, f"{db}.{name}", T._parse_datatype_string(columns))
        run.ingest(spark, rules.parse({"Dest": {"Table": f"{db}.{name}", "SourceFormat": "JSON"}}, name), files[name], f"e_{name}", journal)
    return journal


@register(
    "load_metrics",
    "SELECT 'nation' AS rule, COUNT(*) AS n_rows, COUNT(DISTINCT n_regionkey) AS n_valid, 1 AS n_bad FROM nation UNION ALL SELECT 'supplier', COUNT(*), 2, 0 FROM supplier",
)
def load_metrics(spark, d):
    """What two loads counted while they wrote: rows, and files by what became of them."""
    of = lambda kind: F.size(F.filter("files", lambda f: f["kind"] == kind)).cast("long")
    loads = spark.table(_two_loads(spark, d).loads)
    return loads.select("rule", F.col("rows").alias("n_rows"), of("valid").alias("n_valid"), of("corrupted").cast("int").alias("n_bad"))


@register(
    "monitor_report",
    """
    SELECT (SELECT COUNT(*) FROM nation) + (SELECT COUNT(*) FROM supplier) AS all_rows, 2 AS n_done, * FROM (
        SELECT 'nation' AS rule, COUNT(*) AS n_rows, 1 AS done, 0 AS running, 1 AS n_corrupted FROM nation UNION ALL SELECT 'supplier', COUNT(*), 1, 0, 0 FROM supplier)
    """,
)
def monitor_report(spark, d):
    journal = _two_loads(spark, d)
    report = monitor.load_report(journal.latest(), spark.table(journal.loads), F.current_timestamp())
    rows = report.select("rows", "n_done", F.explode("dests").alias("x"))
    return rows.select(F.col("rows").alias("all_rows"), F.col("n_done").cast("int").alias("n_done"), "x.rule", F.col("x.rows").alias("n_rows"), F.col("x.done.count").cast("int").alias("done"), F.col("x.running.count").cast("int").alias("running"), F.col("x.n_corrupted").cast("int").alias("n_corrupted"))


@register("clustered_split", "SELECT event_id, user_id, event_type = 'click' AS clicked FROM events")
def clustered_split(spark, d):
    """A rule that splits files by type and keeps rows together by day, user and value in every destination."""
    db, at = folder(spark)
    events = table(spark, d, "events").select("event_id", "event_type", "user_id", F.struct("value").alias("info"), F.col("ts").cast("timestamp").alias("ts"))
    events.write.parquet(f"{at}/in")
    publish.create(spark, f"{db}.events", events.schema)
    split = {"ClusterColumns": ["user_id", "info.value"], "TimeColumn": "ts", "Mapping": [{"When": "event_type = 'click'", "Then": f"{db}.clicks"}, {"When": "event_type <> 'click'", "Then": f"{db}.others"}]}
    rule = rules.parse({"Dest": {"Table": f"{db}.events", "SourceFormat": "PARQUET", "Transient": {"Dataset": "t"}, "Schema": {"Split": split}}})
    run.ingest(spark, rule, files_in(spark, f"{at}/in", "*.parquet"), "e")
    return reduce(DataFrame.union, [spark.table(f"{db}.{n}").select("event_id", "user_id", F.lit(n == "clicks").alias("clicked")) for n in ("clicks", "others")])


@register("large_response", "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1")
def large_response(spark, d):
    """A query whose rows no response holds, and one after it that reads all of them."""
    db = scratch(spark)
    publish.write(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), f"{db}.lines")
    read = {"Action": "query", "Request": {"SQL": f"SELECT l_orderkey, l_suppkey FROM {db}.lines"}}
    ctx = act(spark, read)
    rows = ctx.variables.values.get("RowsTable")
    if rows is None:  # few enough for the response itself
        spark.createDataFrame(ctx.variables.values["Rows"], "l_orderkey long, l_suppkey long").createOrReplaceTempView(rows := f"held_{uuid.uuid4().hex}")
    return spark.sql(f"SELECT l_suppkey, COUNT(1) AS n FROM {rows} GROUP BY l_suppkey")


@register("offset_sql", "SELECT c_custkey, CAST(k - 1 AS INTEGER) AS place, parts[k] AS part FROM (SELECT c_custkey, string_split(c_name, '#') AS parts FROM customer), unnest(range(1, len(parts) + 1)) AS t(k)")
def offset_sql(spark, d):
    """A delimiter in double quotes, and the places of an array's elements."""
    view = f"customers_{uuid.uuid4().hex[:8]}"
    table(spark, d, "customer").createOrReplaceTempView(view)
    return publish.query(spark, f'SELECT t.c_custkey, o AS place, p AS part FROM {view} t, UNNEST(SPLIT(t.c_name, "#")) AS p WITH OFFSET AS o')


@register("window_stream", "SELECT r_regionkey, r_name FROM region")
def window_stream(spark, d):
    """Windows kept open in a stream's state, over a restart with files that come late; all rows count once."""
    from siltworks.streaming.windows import run_windows

    db, at = folder(spark)
    region = table(spark, d, "region").select("r_regionkey", "r_name", F.col("r_regionkey").alias("k"))
    publish.create(spark, f"{db}.region", region.drop("k").schema)
    rule = rules.parse({"When": {"Prefix": "/", "Suffix": ".json"}, "Dest": {"Table": f"{db}.region"}, "Batch": {"Window": {"DurationInSec": 10}, "MultiPath": True}})
    journal, ran = run.Journal(spark, f"{db}.journal"), []
    for part in ("k < 3", "k >= 3"):
        region.where(part).repartition(1).write.mode("append").partitionBy("k").json(f"{at}/in")
        want = len(files_in(spark, f"{at}/in"))
        query = run_windows(spark, f"{at}/in", rule, f"{at}/state", journal, ahead_seconds=3600, trigger={"processingTime": "1 second"}, ran=ran)
        end = time.time() + 120
        while sum(len(o.rows_from) for o in ran) < want and time.time() < end and query.exception() is None:
            time.sleep(0.2)
        query.stop()
    return spark.table(f"{db}.region")
