"""Registered queries: each applies operators to whole tables; SQL gives the same rows."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import naming
from siltworks.functions.dialect import to_spark
from siltworks.operators import monitor, publish
from siltworks.operators import transform as tr
from siltworks.sources import files as fs
from siltworks.sources import recovery

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Doubles are summed as decimals, so that results don't depend on the order of rows.
DEC = "decimal(18,4)"


def register(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A query's result reads its tables until it is used up; a day later they go.
SCRATCH_SECONDS = 86_400


def scratch(spark: SparkSession) -> str:
    """A database for one query's tables; drops those of queries of the day before."""
    now = int(time.time())
    for row in spark.sql("SHOW SCHEMAS LIKE 'silt_*'").collect():
        made = re.fullmatch(r"silt_(\d{10})_\w+", row[0])
        if made and int(made[1]) < now - SCRATCH_SECONDS:
            spark.sql(f"DROP SCHEMA IF EXISTS {row[0]} CASCADE")
    name = f"silt_{now}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name}")
    return name


@register(
    "etl_aggregation",
    """
    SELECT EXTRACT(YEAR FROM l.l_shipdate) * 100 + EXTRACT(MONTH FROM l.l_shipdate) AS ship_month, p.p_size // 10 AS size_class, COUNT(*) AS n_lines,
           COUNT(*) FILTER (l.l_discount >= 0.05) AS n_discounted,
           CAST(SUM(CAST(l.l_extendedprice * (1 - l.l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS net,
           CAST(SUM(CAST(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity ELSE 0 END AS DECIMAL(18,4))) AS DOUBLE) AS open_quantity,
           CAST(SUM(CAST(abs(l.l_extendedprice - l.l_quantity * p.p_retailprice) AS DECIMAL(18,4))) AS DOUBLE) AS off_list, MIN(p.p_name) AS first_part
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_tax < 0.07
    GROUP BY 1, 2
    """,
)
def etl_aggregation(spark, d):
    """Sales by month and size of part: what was paid, what is open, and how far prices are off the list."""
    lines = table(spark, d, "lineitem").where("l_tax < 0.07").alias("l")
    side = tr.SideInput("p", "p.p_partkey = l.l_partkey", table="part", inner=True)
    joined = tr.join_side_inputs(lines, [(side, table(spark, d, "part"))])
    total = lambda e: F.sum(F.expr(e).cast(DEC)).cast("double")
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long").alias("ship_month")
    return joined.groupBy(month, F.floor(F.col("p_size") / 10).cast("int").alias("size_class")).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted"),
        total("l_extendedprice * (1 - l_discount)").alias("net"),
        total("case when l_linestatus = 'O' then l_quantity else 0 end").alias("open_quantity"),
        total("abs(l_extendedprice - l_quantity * p_retailprice)").alias("off_list"),
        F.min("p_name").alias("first_part"),
    )


@register(
    "select_all_transform",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           lower(l_returnflag) AS l_returnflag, l_linestatus, l_shipdate, l_orderkey % 2 AS shard, l_extendedprice * (1 - l_discount) AS net
    FROM lineitem
    """,
)
def select_all_transform(spark, d):
    return tr.transform(table(spark, d, "lineitem"), columns={"L_RETURNFLAG": "lower(t.l_returnflag)", "shard": "MOD(t.l_orderkey, 2)", "net": "t.l_extendedprice * (1 - t.l_discount)"})


@register("column_exclusion", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def column_exclusion(spark, d):
    dest = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_mktsegment", T.StringType())])
    return tr.transform(table(spark, d, "customer"), dest=dest)


@register("criteria_filter", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 100000")
def criteria_filter(spark, d):
    return tr.transform(table(spark, d, "orders"), criteria="t.o_orderstatus IN ('F', 'O') AND t.o_totalprice > 100000")


@register("side_input_left", "SELECT o.*, c.c_mktsegment AS segment FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0")
def side_input_left(spark, d):
    side = tr.SideInput("c", "t.o_custkey = c.c_custkey AND c.c_acctbal > 0", table="customer")
    return tr.transform(table(spark, d, "orders"), columns={"segment": "c.c_mktsegment"}, sides=[(side, table(spark, d, "customer"))])


@register("side_input_inner", "SELECT o.*, c.c_mktsegment AS segment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0")
def side_input_inner(spark, d):
    side = tr.SideInput("c", "t.o_custkey = c.c_custkey AND c.c_acctbal > 0", table="customer", inner=True)
    return tr.transform(table(spark, d, "orders"), columns={"segment": "c.c_mktsegment"}, sides=[(side, table(spark, d, "customer"))])


@register(
    "side_input_subquery",
    "SELECT o.*, c.n AS n_in_segment FROM orders o LEFT JOIN (SELECT c_nationkey, COUNT(1) AS n FROM customer GROUP BY 1) c ON o.o_custkey % 25 = c.c_nationkey",
)
def side_input_subquery(spark, d):
    view = f"customer_{uuid.uuid4().hex[:8]}"
    table(spark, d, "customer").createOrReplaceTempView(view)
    side = tr.SideInput("c", "t.o_custkey % 25 = c.c_nationkey", query=f"SELECT c_nationkey, COUNT(1) AS n FROM {view} GROUP BY 1")
    return tr.transform(table(spark, d, "orders"), columns={"n_in_segment": "c.n"}, sides=[(side, side.rows(spark))])


@register(
    "side_input_multi",
    """
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority, n.n_name AS nation, r.r_name AS region
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON o.o_orderkey IS NOT NULL AND c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
)
def side_input_multi(spark, d):
    sides = [
        tr.SideInput("c", "t.o_custkey = c.c_custkey", table="customer", inner=True),
        tr.SideInput("n", "t.o_orderkey IS NOT NULL AND c.c_nationkey = n.n_nationkey", table="nation"),
        tr.SideInput("r", "n.n_regionkey = r.r_regionkey", table="region"),
    ]
    return tr.transform(table(spark, d, "orders"), columns={"nation": "n.n_name", "region": "r.r_name"}, sides=[(s, table(spark, d, s.table)) for s in sides])


@register(
    "side_input_theta",
    "SELECT o.*, s.name AS band FROM orders o LEFT JOIN (SELECT r_regionkey * 100000 AS lo, r_regionkey * 100000 + 100000 AS hi, r_name AS name FROM region) s ON o.o_totalprice >= s.lo AND o.o_totalprice < s.hi",
)
def side_input_theta(spark, d):
    view = f"region_{uuid.uuid4().hex[:8]}"
    table(spark, d, "region").createOrReplaceTempView(view)
    side = tr.SideInput("s", "t.o_totalprice >= s.lo AND t.o_totalprice < s.hi", query=f"SELECT r_regionkey * 100000 AS lo, r_regionkey * 100000 + 100000 AS hi, r_name AS name FROM {view}")
    return tr.transform(table(spark, d, "orders"), columns={"band": "s.name"}, sides=[(side, side.rows(spark))])


@register(
    "dedupe_flat_max",
    """
    SELECT l_orderkey, MAX(l_partkey) AS l_partkey, MAX(l_suppkey) AS l_suppkey, MAX(l_linenumber) AS l_linenumber, MAX(l_quantity) AS l_quantity,
           MAX(l_extendedprice) AS l_extendedprice, MAX(l_discount) AS l_discount, MAX(l_tax) AS l_tax, MAX(lower(l_returnflag)) AS l_returnflag,
           MAX(l_linestatus) AS l_linestatus, MAX(l_shipdate) AS l_shipdate
    FROM lineitem GROUP BY l_orderkey
    """,
)
def dedupe_flat_max(spark, d):
    return tr.transform(table(spark, d, "lineitem"), keys=["l_orderkey"], columns={"l_returnflag": "lower(t.l_returnflag)"})


@register(
    "dedupe_join_max",
    """
    SELECT l_orderkey, MAX(l_partkey) AS l_partkey, MAX(l_suppkey) AS l_suppkey, MAX(l_linenumber) AS l_linenumber, MAX(l_quantity) AS l_quantity,
           MAX(l_extendedprice) AS l_extendedprice, MAX(l_discount) AS l_discount, MAX(l_tax) AS l_tax, MAX(l_returnflag) AS l_returnflag,
           MAX(l_linestatus) AS l_linestatus, MAX(l_shipdate) AS l_shipdate, MAX(l_extendedprice + p_retailprice) AS charge
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
    """,
)
def dedupe_join_max(spark, d):
    side = tr.SideInput("f", "t.l_partkey = f.p_partkey", table="part")
    return tr.transform(table(spark, d, "lineitem"), keys=["l_orderkey"], columns={"charge": "t.l_extendedprice + f.p_retailprice"}, sides=[(side, table(spark, d, "part"))])


@register(
    "dedupe_nested_row_number",
    "SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS head, len(embedding) AS dim FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings) WHERE n = 1",
)
def dedupe_nested_row_number(spark, d):
    once = tr.transform(table(spark, d, "embeddings"), keys=["label"], order=["vec_id"])
    return once.select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("head"), F.size("embedding").cast("long").alias("dim"))


@register("split_mod", "SELECT *, 'orders_' || CAST(o_orderkey % 2 AS VARCHAR) AS dest FROM orders")
def split_mod(spark, d):
    return publish.split(table(spark, d, "orders"), [("MOD(o_orderkey, 2) = 0", "orders_0"), ("MOD(o_orderkey, 2) = 1", "orders_1")])


@register(
    "split_overlap",
    """
    SELECT *, 'big' AS dest FROM orders WHERE o_totalprice > 200000
    UNION ALL SELECT *, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT *, 'open' FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 50000
    """,
)
def split_overlap(spark, d):
    return publish.split(table(spark, d, "orders"), [("o_totalprice > 200000", "big"), ("o_orderpriority = '1-URGENT'", "urgent"), ("o_orderstatus = 'O' AND o_totalprice < 50000", "open")])


@register("split_typed_null", "SELECT o_orderkey, CAST(NULL AS TIMESTAMP) AS ts, o_totalprice, 'open' AS dest FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, NULL, o_totalprice, 'any' FROM orders")
def split_typed_null(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.expr(to_spark("TIMESTAMP(NULL)")).alias("ts"), "o_totalprice", "o_orderstatus")
    return publish.split(rows, [("o_orderstatus = 'O' AND ts IS NULL", "open"), ("COALESCE(ts, TIMESTAMP(NULL)) IS NULL", "any")]).drop("o_orderstatus")


@register(
    "split_nested_column",
    "SELECT event_id, user_id, event_type FROM events WHERE user_id % 3 = 0",
)
def split_nested_column(spark, d):
    nested = table(spark, d, "events").select("event_id", F.struct("user_id", "event_type").alias("meta"))
    flat = publish.split_columns(nested, ["meta.user_id", "meta.event_type"])
    return publish.split(flat, [("MOD(user_id, 3) = 0", "x")]).select("event_id", "user_id", "event_type")


def pseudo_files(spark, d):
    """Events as files: a url of type and user folder, and a time."""
    url = F.concat(F.lit("s3://lake/data/"), F.col("event_type"), F.lit("/u"), F.col("user_id") % 10, F.lit("/"), F.col("event_id"), F.lit(".json"))
    return table(spark, d, "events").select("event_id", url.alias("url"), F.col("ts").alias("modified"))


@register(
    "batch_window_assign",
    """
    SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 95 AS start_sec,
           CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 95 + 95 AS end_sec
    FROM events
    """,
)
def batch_window_assign(spark, d):
    w = fs.batch_windows(pseudo_files(spark, d), 95, F.lit("lake.events"))
    at = lambda c: F.unix_timestamp(F.to_timestamp(c)).cast("long")
    return w.select("event_id", at("window_start").alias("start_sec"), at("window_end").alias("end_sec"))


@register(
    "batch_group_members",
    """
    SELECT event_type, user_id % 10 AS folder, CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 3600 + 3600 AS end_sec,
           COUNT(*) AS n_files, MIN(event_id) AS least, MAX(event_id) AS most
    FROM events GROUP BY 1, 2, 3
    """,
)
def batch_group_members(spark, d):
    files = pseudo_files(spark, d).withColumns({"event_type": F.regexp_extract("url", r"/data/([^/]+)/", 1), "folder": F.regexp_extract("url", r"/u(\d+)/", 1).cast("long")})
    w = fs.batch_windows(files, 3600, F.lit("lake.events"))
    out = w.groupBy("group", "window_end").agg(
        F.min("event_type").alias("event_type"), F.min("folder").alias("folder"), F.count("*").alias("n_files"), F.min("event_id").alias("least"), F.max("event_id").alias("most")
    )
    return out.select("event_type", "folder", F.unix_timestamp(F.to_timestamp("window_end")).cast("long").alias("end_sec"), "n_files", "least", "most")


@register(
    "due_windows",
    """
    SELECT event_type, CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 86400 + 86400 AS end_sec, COUNT(*) AS n_files
    FROM events WHERE CAST(epoch_us(ts) // 1000000 AS BIGINT) - CAST(epoch_us(ts) // 1000000 AS BIGINT) % 86400 + 86400 + 7 <= (SELECT CAST(epoch_us(max(ts)) // 1000000 AS BIGINT) FROM events)
    GROUP BY 1, 2
    """,
)
def due_windows(spark, d):
    files = pseudo_files(spark, d)
    now = files.agg(F.max("modified")).first()[0]
    kind = F.regexp_extract("url", r"/data/([^/]+)/", 1)
    w = fs.batch_windows(files, 86_400, kind, multi_path=True)
    due = fs.due_windows(w, F.lit(now), 7)
    return due.select(F.col("dest").alias("event_type"), F.unix_timestamp(F.to_timestamp("window_end")).cast("long").alias("end_sec"), F.size("files").cast("long").alias("n_files"))


@register(
    "file_match",
    "SELECT page_id, url FROM pages WHERE regexp_matches(regexp_replace(url, '^https?://[^/]+', ''), '[0-9]') AND url NOT LIKE '%1%'",
)
def file_match(spark, d):
    rule = fs.Match(filter="[0-9]", exclusion="1")
    path = F.regexp_replace("url", r"^https?://[^/]+", "")
    pages = table(spark, d, "pages")
    return pages.where(rule.condition(path)).where(~F.col("url").contains("1")).select("page_id", "url")


@register("url_pattern_params", r"SELECT page_id, lower(regexp_extract(url, '^(https?)://([^/]+)/', 1)) AS scheme, replace(regexp_extract(url, '^(https?)://([^/]+)/', 2), '.', '_') AS host FROM pages")
def url_pattern_params(spark, d):
    """Named parameters of each url: groups of a pattern through text functions."""
    params = [naming.Param("scheme", "$ToLower($1)"), naming.Param("host", "$Replace($2, '.', '_')")]
    pattern = r"^(https?)://([^/]+)/"

    group = lambda k: F.regexp_extract("url", pattern, k)
    return table(spark, d, "pages").select("page_id", *[naming.text_column(p.expression, group).alias(p.name) for p in params])


@register(
    "shard_by_hash",
    f"""
    WITH p AS (SELECT page_id, hex(encode(url)) AS h FROM pages),
    b AS (SELECT page_id, list_transform(range(0, len(h) // 2), lambda i: CAST((instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS UBIGINT)) AS bytes FROM p),
    f AS (
        SELECT page_id, list_reduce(list_prepend(CAST({naming.FNV_BASIS} AS UBIGINT), bytes),
               lambda h, x: xor(CAST(CAST(h AS UHUGEINT) * {naming.FNV_PRIME} % 18446744073709551616 AS UBIGINT), x)) AS h FROM b
    )
    SELECT page_id, CAST((CASE WHEN h >= 9223372036854775808 THEN 18446744073709551616 - CAST(h AS UHUGEINT) ELSE CAST(h AS UHUGEINT) END) % 10 AS BIGINT) AS shard FROM f
    """,
)
def shard_by_hash(spark, d):
    @F.pandas_udf("long")
    def shard(url: pd.Series) -> pd.Series:
        return naming.fnv1_many(url) % 10

    return table(spark, d, "pages").select("page_id", shard("url").alias("shard"))


@register(
    "history_anti_join",
    "SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = d.n_chars % 2)",
)
def history_anti_join(spark, d):
    """A file counts again when its time differs from the one that the history has."""
    at = lambda n: F.timestamp_seconds(F.col(n))
    files = table(spark, d, "documents").select("source", F.col("doc_id").alias("url"), F.timestamp_seconds(F.col("n_chars") % 2).alias("modified"))
    history = table(spark, d, "labels").select(F.col("doc_id").alias("url"), at("quality").alias("modified"))
    return fs.unprocessed(files, history).select(F.col("url").alias("doc_id"), "source")


@register(
    "valid_files",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def valid_files(spark, d):
    labels = table(spark, d, "labels").withColumnRenamed("doc_id", "url")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("url"))
    return fs.valid_files(docs, labels.where("quality = 0"), labels.where("toxic = 1")).select(F.col("url").alias("doc_id"))


@register("newest_first_rank", "SELECT event_id, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS nth FROM events")
def newest_first_rank(spark, d):
    events = table(spark, d, "events")
    return monitor.first_errors(events, "event_type", [F.desc("ts"), F.asc("event_id")], shown=2**31 - 1).select("event_id", F.col("nth").cast("long").alias("nth"))


@register("first_errors", "SELECT event_type, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 40")
def first_errors(spark, d):
    return monitor.first_errors(table(spark, d, "events"), "event_type", ["ts", "event_id"]).select("event_type", "event_id")


@register(
    "main_extension",
    "SELECT event_type AS ext, COUNT(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, ext LIMIT 1",
)
def main_extension(spark, d):
    return fs.main_extension(table(spark, d, "events").select(F.concat(F.lit("s3://lake/x."), F.col("event_type")).alias("url")))


@register(
    "partition_override_state",
    "SELECT o_orderkey, o_totalprice, status FROM (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F')",
)
def partition_override_state(spark, d):
    name = f"{scratch(spark)}.orders"
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    publish.create(spark, name, rows.schema, ["status"])
    publish.write(rows, name)
    new = rows.where("status = 'F' AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    publish.override_partitions(new, name, {"status": "F"})
    return spark.table(name)


@register("insert_column_list", "SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer WHERE c_acctbal < 0")
def insert_column_list(spark, d):
    name = f"{scratch(spark)}.customer"
    rows = table(spark, d, "customer")
    publish.create(spark, name, rows.select("c_custkey", "c_name", "c_acctbal").schema)
    publish.insert_columns(rows, name, ["c_custkey", "c_name"])
    publish.insert_columns(rows.where("c_acctbal < 0"), name, ["c_acctbal", "c_custkey"])
    return spark.table(name)


@register("append_then_truncate", "SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey = 1")
def append_then_truncate(spark, d):
    name = f"{scratch(spark)}.nation"
    rows = table(spark, d, "nation")
    publish.write(rows.limit(0), name)
    publish.write(rows.where("n_regionkey = 2"), name)
    publish.write(rows, name, append=False)
    publish.write(rows.where("n_regionkey = 1"), name)
    return spark.table(name)


@register("write_split_tables", "SELECT o_orderkey, 'even' AS kind FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'urgent' FROM orders WHERE o_orderpriority = '1-URGENT'")
def write_split_tables(spark, d):
    db = scratch(spark)
    publish.write_split(table(spark, d, "orders"), [("o_orderkey % 2 = 0", f"{db}.even"), ("o_orderpriority = '1-URGENT'", f"{db}.urgent")])
    return spark.table(f"{db}.even").select("o_orderkey", F.lit("even").alias("kind")).union(spark.table(f"{db}.urgent").select("o_orderkey", F.lit("urgent")))


@register("copy_partitions", "SELECT o_orderkey, o_orderstatus FROM orders")
def copy_partitions(spark, d):
    db = scratch(spark)
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    publish.create(spark, f"{db}.orders", rows.schema, ["o_orderstatus"])
    publish.write(rows, f"{db}.orders")
    names = publish.copy_partitions(spark, f"{db}.orders", "", lambda v: f"{db}.orders_{v.lower()}")
    out = spark.table(names[0])
    for name in names[1:]:
        out = out.unionByName(spark.table(name))
    return out


@register("partition_list", "SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL")
def partition_list(spark, d):
    name = f"{scratch(spark)}.orders"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    publish.create(spark, name, rows.schema, ["o_orderstatus"])
    publish.write(rows, name)
    return publish.partitions(spark, name)


@register("template_patch", "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note FROM supplier UNION ALL SELECT s_suppkey, s_name, 'new' FROM supplier WHERE s_suppkey % 2 = 0")
def template_patch(spark, d):
    db = scratch(spark)
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name")
    publish.write(rows, f"{db}.supplier")
    publish.create(spark, f"{db}.template", rows.withColumn("note", F.lit("")).schema)
    publish.ensure(spark, f"{db}.supplier", f"{db}.template")
    publish.write(rows.where("s_suppkey % 2 = 0").withColumn("note", F.lit("new")), f"{db}.supplier")
    return spark.table(f"{db}.supplier")


@register("json_field_inference", "SELECT event_type, COUNT(*) AS n, SUM(CAST(json_extract(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY 1")
def json_field_inference(spark, d):
    events = table(spark, d, "events")
    found = events.select(F.try_parse_json("props").alias("v")).agg(F.schema_of_variant_agg("v")).first()[0]
    kind = recovery.parse_variant_schema(found)
    if not isinstance(kind, T.StructType) or "k" not in kind.names:
        kind = T.StructType([T.StructField("k", T.LongType())])
    return events.withColumn("x", F.from_json("props", kind)).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("x.k").alias("k"))


@register("ingest_summary", "SELECT source, COUNT(1) AS row_count, MAX(n_chars) AS longest FROM documents GROUP BY 1")
def ingest_summary(spark, d):
    view = f"documents_{uuid.uuid4().hex[:8]}"
    table(spark, d, "documents").createOrReplaceTempView(view)
    return publish.query(spark, f"SELECT source, COUNT(1) AS row_count, MAX(n_chars) AS longest FROM {view} GROUP BY 1")


@register("query_join_action", "SELECT n_name, COUNT(1) AS n, SUM(CAST(c_acctbal AS DECIMAL(18,4)))::DOUBLE AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def query_join_action(spark, d):
    db = scratch(spark)
    tag = uuid.uuid4().hex[:8]
    for name in ("customer", "nation"):
        table(spark, d, name).createOrReplaceTempView(f"{name}_{tag}")
    sql = f"SELECT n_name, COUNT(1) AS n, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,4))) AS DOUBLE) AS total FROM customer_{tag} JOIN nation_{tag} ON c_nationkey = n_nationkey GROUP BY 1"
    publish.query(spark, sql, f"{db}.summary", append=True)
    return spark.table(f"{db}.summary")


@register(
    "monitor_metrics",
    "SELECT event_type, COUNT(*) AS count, MIN(ts) AS first, MAX(ts) AS last, CAST(epoch(TIMESTAMP '2030-01-01') - epoch_us(MIN(ts)) // 1000000 AS BIGINT) AS lag_sec FROM events GROUP BY 1",
)
def monitor_metrics(spark, d):
    return monitor.event_metrics(table(spark, d, "events"), ["event_type"], "ts", F.lit("2030-01-01").cast("timestamp"))


@register(
    "staged_metrics",
    "SELECT user_id, SUM(n)::BIGINT AS count, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS stages FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1",
)
def staged_metrics(spark, d):
    out = monitor.staged_metrics(table(spark, d, "events"), "user_id", "event_type", "ts")
    return out.select("user_id", "count", F.array_join(F.transform("stages", lambda s: F.concat_ws(":", s["stage"], s["count"])), ",").alias("stages"))


@register(
    "throttle_counters",
    "SELECT user_id, n_click, n_view, greatest(0, 5 - n_click) AS open, n_click >= 5 AS throttled FROM (SELECT user_id, COUNT(*) FILTER (event_type = 'click') AS n_click, COUNT(*) FILTER (event_type = 'view') AS n_view FROM events GROUP BY 1)",
)
def throttle_counters(spark, d):
    return monitor.throttled(monitor.state_counts(table(spark, d, "events"), "user_id", "event_type", ["click", "view"]), "n_click", 5)


@register("job_filter", "SELECT event_id FROM events WHERE event_type = 'click' AND regexp_matches(CAST(user_id AS VARCHAR), '^1') AND regexp_matches(props, '[0-4]')")
def job_filter(spark, d):
    jobs = table(spark, d, "events").select("event_id", F.col("event_type").alias("job_type"), F.col("user_id").cast("string").alias("source"), F.col("props").alias("dest"))
    return monitor.select_jobs(jobs, "CLICK", "^1", "[0-4]").select("event_id")


@register("pending_job_states", "SELECT c_custkey AS job_id, COALESCE(o.status, 'not_found') AS state FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_orderstatus) AS status FROM orders GROUP BY 1) o ON c_custkey = o_custkey")
def pending_job_states(spark, d):
    jobs = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("job_id")).agg(F.max("o_orderstatus").alias("state"))
    return monitor.pending_states(table(spark, d, "customer").select(F.col("c_custkey").alias("job_id")), jobs)


@register("stalled_counts", "SELECT event_type, COUNT(*) FILTER (epoch_us(ts) // 1000000 >= m - 5400) AS active, COUNT(*) FILTER (epoch_us(ts) // 1000000 < m - 5400) AS stalled FROM events, (SELECT epoch_us(max(ts)) // 1000000 AS m FROM events) GROUP BY 1")
def stalled_counts(spark, d):
    files = table(spark, d, "events").select(F.concat(F.lit("s3://lake/"), "event_type", F.lit("/x.json")).alias("url"), F.col("ts").cast("timestamp").alias("modified"))
    now = files.agg(F.max("modified")).first()[0]
    out = monitor.stalled(files, F.lit(now))
    return out.select(F.regexp_extract("folder", r"([^/]+)$", 1).alias("event_type"), "active", "stalled")


@register("latest_report_top1", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 1")
def latest_report_top1(spark, d):
    return monitor.latest(table(spark, d, "events").select("event_id", "ts", "event_type"), "ts", "event_id")


@register("array_sum", "SELECT o_custkey, SUM(n)::BIGINT AS total, COUNT(*) AS kinds FROM (SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def array_sum(spark, d):
    items = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("count"))
    nested = items.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderstatus", "count")).alias("items"))
    return nested.select("o_custkey", monitor.sum_in_array("items", "count").alias("total"), F.size("items").cast("long").alias("kinds"))


@register("conditional_exists", "SELECT * FROM (VALUES ('region', true), ('absent', false)) v(name, found)")
def conditional_exists(spark, d):
    db = scratch(spark)
    publish.write(table(spark, d, "region"), f"{db}.region")
    return spark.createDataFrame([(n, publish.exists(spark, f"{db}.{n}")) for n in ("region", "absent")], "name string, found boolean")


@register("export_roundtrip", "SELECT f AS format, n_nationkey, n_name, n_regionkey FROM nation, (VALUES ('csv'), ('json'), ('parquet')) v(f)")
def export_roundtrip(spark, d):
    nation = table(spark, d, "nation")
    folder = spark.sql(f"DESCRIBE SCHEMA {scratch(spark)}").where("info_name = 'Location'").first()["info_value"]
    out = None
    for kind in ("csv", "json", "parquet"):
        publish.export(nation, f"{folder}/nation.{kind}", compression=None if kind == "parquet" else "GZIP")
        options = fs.LoadOptions(kind, skip_leading_rows=1)
        rows = fs.load(spark, [f"{folder}/nation.{kind}"], nation.schema, options).select(F.lit(kind).alias("format"), *nation.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@register("literal_split", "SELECT c_custkey, string_split(c_name, '#')[1] AS head, len(string_split(c_name, '#')) AS parts FROM customer")
def literal_split(spark, d):
    return table(spark, d, "customer").selectExpr("c_custkey", to_spark("SPLIT(c_name, '#')") + "[0] AS head", "CAST(size(" + to_spark("SPLIT(c_name, '#')") + ") AS BIGINT) AS parts")
