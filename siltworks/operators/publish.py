"""Writing results: append, overwrite, partitions, column lists, splits, templates, exports."""

from __future__ import annotations

import json
import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import schemas
from siltworks.functions.dialect import is_dml, to_spark
from siltworks.functions.naming import TableRef

EXPIRES = "siltworks.expires_at"
REQUIRED = "siltworks.required"


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema)


def create(spark: SparkSession, table: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
    """Create the table, and its database, unless they exist."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{table.split('.')[0]}`") if "." in table else None
    partitions = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    needed = [f.name for f in schema if not f.nullable]
    noted = f" TBLPROPERTIES ('{REQUIRED}' = '{_quoted(json.dumps(needed))}')" if needed else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(schema)}) USING parquet{partitions}{noted}")


def optional(schema: T.StructType) -> T.StructType:
    """A schema whose columns all take nulls: what rows happen to lack is no promise of their table."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def required_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns that take no nulls. Tables of files forget that of their schema, so it is a property."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == REQUIRED).collect()
    return json.loads(found[0]["value"]) if found else []


def relax(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Let columns take nulls from now on; no file is written anew."""
    left = [c for c in required_columns(spark, table) if c not in columns]
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{REQUIRED}' = '{_quoted(json.dumps(left))}')")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def patch(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Add what a schema has besides; a field within a struct means writing the table anew."""
    old = spark.table(table).schema
    if schemas.equal(old, schema):
        return
    names = {f.name.lower() for f in old}
    new = [f for f in schema if f.name.lower() not in names]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(T.StructType([T.StructField(f.name, f.dataType) for f in new]))})")
    nested = schemas.unknown_fields(schema, spark.table(table).schema)
    if nested:
        merged = schemas.merge(spark.table(table).schema, schema)
        rows = spark.table(table)
        staged = f"{table}__staged"
        create(spark, staged, merged, partition_columns(spark, table))
        _insert(conform(rows, merged), staged, overwrite=True)
        aside = f"{table}__before"
        # the old table goes last: at any time one of the three names has all rows
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        spark.sql(f"DROP TABLE {aside}")


def ensure(spark: SparkSession, table: str, template: str) -> None:
    """Create the table like a template, or patch it if it differs and can take the change."""
    schema = spark.table(template).schema
    if not exists(spark, table):
        needed = required_columns(spark, template)
        create(spark, table, T.StructType([T.StructField(f.name, f.dataType, f.name not in needed) for f in schema]), partition_columns(spark, template))
    elif not schemas.equal(spark.table(table).schema, schema):
        if not schemas.patchable(spark.table(table).schema, schema):
            raise ValueError(f"{table} can't take the schema of {template}")
        patch(spark, table, schema)


def _conformed(column, found: T.DataType, wanted: T.DataType):
    if isinstance(wanted, T.StructType) and isinstance(found, T.StructType):
        have = {f.name.lower(): f for f in found}
        parts = []
        for f in wanted:
            own = have.get(f.name.lower())
            parts.append((_conformed(column[own.name], own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)).alias(f.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(found, T.ArrayType) and isinstance(wanted.elementType, T.StructType):
        return F.transform(column, lambda x: _conformed(x, found.elementType, wanted.elementType))
    return column if found == wanted else column.cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a table in its order, by name at every depth; those df lacks are null."""
    have = {f.name.lower(): f for f in df.schema}
    out = []
    for f in schema:
        own = have.get(f.name.lower())
        column = _conformed(df[f"`{own.name}`"], own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
        out.append(column.alias(f.name))
    return df.select(*out)


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail on nulls in required columns, within the write itself."""
    have = {c.lower(): c for c in df.columns}
    checks = {have[c.lower()]: F.coalesce(F.col(f"`{have[c.lower()]}`"), F.raise_error(F.lit(f"null in required column {c}"))) for c in columns if c.lower() in have}
    return df.withColumns(checks) if checks else df


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    df.write.insertInto(table, overwrite=overwrite)


def write(df: DataFrame, table: str, append: bool = True, schema: T.StructType | None = None) -> None:
    """Append rows to a table or replace all of them, by column name; creates a missing table."""
    spark = df.sparkSession
    if not exists(spark, table):
        create(spark, table, schema or optional(df.schema))
    needed = [f.name for f in schema if not f.nullable] if schema else required_columns(spark, table)
    rows = required(conform(df, spark.table(table).schema), needed)
    if not append and partition_columns(spark, table):
        with overwrite_mode(spark, "static"):
            _insert(rows, table, True)
        return
    _insert(rows, table, not append)


class overwrite_mode:  # noqa: N801  reads as a clause
    """partitionOverwriteMode for a block."""

    KEY = "spark.sql.sources.partitionOverwriteMode"

    def __init__(self, spark: SparkSession, mode: str):
        self.spark, self.mode = spark, mode

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY)
        self.spark.conf.set(self.KEY, self.mode)

    def __exit__(self, *_):
        self.spark.conf.set(self.KEY, self.old)


def within(rows: DataFrame, only: dict[str, object] | None) -> DataFrame:
    """The rows, with any that is of another partition failing what reads it."""
    for name, value in (only or {}).items():
        wrong = F.raise_error(F.concat(F.lit(f"row outside partition {name}="), F.coalesce(F.col(name).cast("string"), F.lit("null"))))
        rows = rows.withColumn(name, F.when(F.col(name).eqNullSafe(F.lit(value)), F.col(name)).otherwise(wrong))
    return rows


def folder_name(value: object) -> str:
    """A partition's value as its folder has it."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^" or ord(c) < 32 or ord(c) == 127 else c for c in text)


def override_partitions(df: DataFrame, table: str, only: dict[str, object] | None = None) -> None:
    """Replace the partitions that df has rows of; all others stay.

    With `only`, any row of another partition fails the write before a partition is replaced.
    """
    spark = df.sparkSession
    rows = within(conform(df, spark.table(table).schema), only)
    with overwrite_mode(spark, "dynamic"):
        _insert(rows, table, True)


def insert_columns(df: DataFrame, table: str, columns: list[str]) -> None:
    """INSERT INTO table (columns): those not listed become null."""
    write(df.select(*columns), table, append=True)


def split(df: DataFrame, mappings: list[tuple[str, str]]) -> DataFrame:
    """Rows tagged with the destination of every predicate they meet, in one pass.

    Predicates are independent: a row that meets two is there twice, one that meets none is
    not there.
    """
    dests = F.array_compact(F.array(*[F.when(F.expr(to_spark(when)), F.lit(then)) for when, then in mappings]))
    return df.withColumn("dest", F.explode(dests))


def stage_split(df: DataFrame, table: str, cluster: list[str], time_column: str | None = None) -> DataFrame:
    """Rows written once to a table that a split then reads for each destination.

    The table has partitions by day of the time column, and the rows of each file are sorted by
    the cluster columns, so that a predicate on either skips files or row groups.
    """
    spark, rows = df.sparkSession, split_columns(df, cluster, time_column)
    by = [c.rpartition(".")[2] for c in cluster]
    if time_column:
        rows = rows.withColumn("_day", F.to_date(time_column))
    create(spark, table, rows.schema, ["_day"] if time_column else None)
    order = (["_day"] if time_column else []) + by
    # Spark sets the number of partitions and splits days that hold more than others
    _insert(rows.hint("rebalance", *order).sortWithinPartitions(*order) if order else rows, table, overwrite=True)
    return spark.table(table).drop("_day")


#: Ranges of a column that clustering tells apart: 2 to this power.
CLUSTER_BITS = 8


def order_number(column: Column, kind: T.DataType) -> Column:
    """A number in the order of a column's values; texts count by their first six bytes."""
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _count_below(bounds: Column, number: Column) -> Column:
    return F.size(F.filter(bounds, lambda b: b < number))


def clustered(df: DataFrame, columns: list[str], bits: int = CLUSTER_BITS) -> DataFrame:
    """Rows in an order that keeps them together by each of several columns.

    Every column's values are numbered by ranges of about equal numbers of rows, found in one pass
    of approximate percentiles, and the bits of these numbers are interleaved. Ranges of that key
    are written together, so files and row groups have narrow bounds on all columns. Nulls lie
    first; a column that can't be ordered by a number counts as one range.
    """
    kinds = {c: df.select(c).schema[0].dataType for c in columns}
    numbers = {c: order_number(F.col(c), kinds[c]) for c in columns if isinstance(kinds[c], T.AtomicType) and not isinstance(kinds[c], T.BinaryType)}
    if not numbers:
        return df
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(n, cuts, 10_000).alias(str(k)) for k, n in enumerate(numbers.values())]).first()
    key = F.lit(0).cast("long")
    for k, number in enumerate(numbers.values()):
        bounds = sorted(set(found[k] or []))
        above = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>")
        range_ = F.when(number.isNull(), 0).otherwise(_count_below(above, number) + 1)
        for bit in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(range_, bit).bitwiseAND(1).cast("long"), bit * len(numbers) + k))
    return df.withColumn("_key", key).repartitionByRange("_key").sortWithinPartitions("_key").drop("_key")


def write_split(df: DataFrame, mappings: list[tuple[str, str]], append: bool = True, template: str | None = None) -> None:
    """Write the rows that meet each predicate to its table; df is computed and written once."""
    from siltworks.operators import commit

    commit.Commits(df.sparkSession, None).publish("split", commit.stage_split(df, mappings, append, template))


def split_columns(df: DataFrame, cluster: list[str], time_column: str | None = None) -> DataFrame:
    """Nested cluster columns promoted to the top by their last name; a missing time column as a null."""
    names = {c.lower() for c in df.columns}
    for c in cluster:
        last = c.rpartition(".")[2]
        if "." in c and last.lower() not in names:
            df = df.withColumn(last, F.col(c))
    if time_column and time_column.lower() not in names:
        df = df.withColumn(time_column, F.lit(None).cast("timestamp"))
    return df


def copy(spark: SparkSession, source: str, dest: str, append: bool = False, template: str | None = None) -> None:
    """Copy a table, or one partition of it as table$value, into another of its columns or more."""
    ref = TableRef.parse(source) if "." in source else None
    rows = spark.table(ref.name if ref else source)
    if ref and ref.partition:
        key = partition_columns(spark, ref.name)[0]
        rows = rows.where(F.date_format(key, "yyyyMMdd") == ref.partition if dict(rows.dtypes)[key] == "date" else F.col(key).cast("string") == ref.partition)
    if template:
        ensure(spark, dest, template)
    if exists(spark, dest) and not schemas.can_copy(rows.schema, spark.table(dest).schema):
        raise ValueError(f"{dest} lacks columns of {source}")
    write(rows, dest, append)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """Values of the table's first partition column, without null, in order, from the catalog alone."""
    key = partition_columns(spark, table)[0]
    kind = dict(spark.table(table).dtypes)[key]
    value = F.regexp_extract("partition", rf"(?:^|/){re.escape(key)}=([^/]*)", 1)
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(key)).distinct()
    return listed.where(f"`{key}` <> '__HIVE_DEFAULT_PARTITION__'").select(F.col(key).cast(kind)).orderBy(key)


def copy_partitions(spark: SparkSession, source: str, dest: str, table_of=None, sql: str | None = None) -> list[str]:
    """Copy every partition, or those that a statement gives as partition_id.

    table_of(value) names a table for each, else all go to dest at once.
    """
    chosen = None
    if sql:
        key, kind = partition_columns(spark, source)[0], dict(spark.table(source).dtypes)
        kind = kind[key]
        given = spark.sql(to_spark(sql)).select(F.col("partition_id").cast("string").alias("_id")).distinct()
        of_rows = F.date_format(key, "yyyyMMdd") if kind == "date" else F.col(key).cast("string")
        if table_of is None:
            rows = spark.table(source)
            create(spark, dest, rows.schema, partition_columns(spark, source))
            override_partitions(rows.join(given, of_rows == F.col("_id"), "left_semi"), dest)
            return [dest]
        chosen = partitions(spark, source).join(given, of_rows == F.col("_id"), "left_semi").orderBy(key)
    if table_of is None:
        create(spark, dest, spark.table(source).schema, partition_columns(spark, source))
        override_partitions(spark.table(source), dest)
        return [dest]
    key = partition_columns(spark, source)[0]
    out = []
    for row in (chosen if chosen is not None else partitions(spark, source)).collect():
        out.append(table_of(row[0]))
        write(spark.table(source).where(F.col(key) == F.lit(row[0])), out[-1], append=False)
    return out


def query(spark: SparkSession, sql: str, dest: str | None = None, append: bool = False, template: str | None = None) -> DataFrame | None:
    """Run SQL of a rule; with a destination its rows go there. INSERT is Spark's, other DML goes by `dml`."""
    from siltworks.operators import dml

    sql = to_spark(sql)
    if is_dml(sql):
        return None if dml.run(spark, sql) else spark.sql(sql)
    if not dest:
        return spark.sql(sql)
    if template:
        ensure(spark, dest, template)
    write(spark.sql(sql), dest, append)
    return None


def export(df: DataFrame, url: str, fmt: str | None = None, compression: str | None = None, header: bool = True, delimiter: str = ",") -> None:
    """Write rows as CSV, NDJSON, Avro or Parquet files; the format may come from the URL."""
    low = url.lower()
    kind = (fmt or next((k for k in ("csv", "avro", "parquet", "orc") if f".{k}" in low), "json")).lower()
    kind = "json" if kind in ("newline_delimited_json", "json") else kind
    writer = df.write.mode("overwrite")
    if compression or low.endswith(".gz"):
        writer = writer.option("compression", (compression or "gzip").lower())
    if kind == "csv":
        writer = writer.option("header", str(header).lower()).option("sep", delimiter)
    writer.format(kind).save(url)


def insert(spark: SparkSession, rows: list[dict] | str, dest: str, template: str | None = None) -> None:
    """Append a few rows, or the rows of a SQL statement."""
    if template:
        ensure(spark, dest, template)
    df = spark.sql(to_spark(rows)) if isinstance(rows, str) else spark.createDataFrame(rows, spark.table(dest).schema)
    write(df, dest, append=True)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def set_expiry(spark: SparkSession, table: str, seconds: int, now: datetime | None = None) -> None:
    """Note in the table's properties when it may go; `sweep` drops it then."""
    at = (now or datetime.now(timezone.utc)) + timedelta(seconds=seconds)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{EXPIRES}' = '{at.isoformat()}')")


def sweep(spark: SparkSession, database: str, now: datetime | None = None) -> list[str]:
    """Drop the tables of a database whose time has passed."""
    now, gone = now or datetime.now(timezone.utc), []
    for t in spark.catalog.listTables(database):
        name = f"{database}.{t.name}"
        found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == EXPIRES).collect() if not t.isTemporary else []
        if found and datetime.fromisoformat(found[0]["value"]) <= now:
            drop(spark, name)
            gone.append(name)
    return gone
