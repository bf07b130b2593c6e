"""Files as sources: manifests, matching, batch windows and loading."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "url string, modified timestamp, size long"

#: Load options of rules and the reader options they stand for.
CSV_OPTIONS = {"FieldDelimiter": "sep", "Quote": "quote", "AllowQuotedNewlines": "multiLine", "Encoding": "encoding", "NullMarker": "nullValue"}


def manifest(spark: SparkSession, url: str, pattern: str | None = None) -> DataFrame:
    """url, modified and size of all files below a folder, without reading any content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(url).select(F.col("path").alias("url"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def path_of(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^(gs|s3|s3a|abfss?|hdfs|viewfs)://[^/]+", ""), r"^file:/*(?=/)", "")


@dataclass(frozen=True)
class Match:
    """Which files a rule takes: prefix, suffix, pattern and exclusion on the path of the URL."""

    prefix: str = ""
    suffix: str = ""
    filter: str | None = None
    exclusion: str | None = None

    def condition(self, url: Column) -> Column:
        path = path_of(url)
        out = path.startswith(self.prefix) & path.endswith(self.suffix)
        if self.filter:
            out &= path.rlike(self.filter)
        if self.exclusion:
            out &= ~path.rlike(self.exclusion)
        return out


def settled(files: DataFrame, now: Column, seconds: int) -> DataFrame:
    """Files that were last written more than so many seconds ago."""
    return files.where(F.col("modified") < now - F.expr(f"interval {int(seconds)} seconds"))


def unprocessed(files: DataFrame, history: DataFrame) -> DataFrame:
    """Files that the history doesn't have with the same time; a file written anew counts again."""
    return files.join(history.select("url", "modified").distinct(), ["url", "modified"], "left_anti")


def valid_files(files: DataFrame, *bad: DataFrame) -> DataFrame:
    """Files that none of the tables of bad urls names."""
    for other in bad:
        files = files.join(other.select("url").distinct(), "url", "left_anti")
    return files


def removed(known: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Known files (rules, say) that a snapshot of their folder no longer has."""
    return known.join(snapshot.select("url").distinct(), "url", "left_anti")


def look_back(files: DataFrame, now: Column, most_seconds: int) -> DataFrame:
    """One row, since: the time of the oldest file, but no more than so many seconds ago."""
    floor = now - F.expr(f"interval {int(most_seconds)} seconds")
    return files.agg(F.greatest(F.min("modified"), floor).alias("since"))


def batch_windows(
    files: DataFrame, seconds: int, dest: Column, multi_path: bool = False, pattern: str | None = None, roll_over: bool = False, suffix: str = ""
) -> DataFrame:
    """Add group, window_start and window_end: the tumbling window of each file's time.

    Files of one batch share destination, the rule's suffix, extension and, unless multi_path,
    their folder; with a pattern also what its groups match. A time on a boundary begins the next window. With roll
    over, a window without one before it takes files from one more length back: its first file
    must lie in its second half.
    """
    folder = F.lit("") if multi_path else F.regexp_extract("url", r"^(.*)/[^/]*$", 1)
    extension = F.regexp_extract("url", r"\.(\w+)$", 1)
    parts = [dest, F.lit(suffix), extension, folder]
    if pattern:
        # groups beside each other, as the hash of a pattern's groups has them
        parts.append(F.concat_ws("\0", *[F.regexp_extract("url", pattern, k + 1) for k in range(re.compile(pattern).groups)]))
    window = F.window("modified", f"{int(seconds)} seconds")
    out = files.withColumns({"dest": dest, "group": F.sha1(F.concat_ws("|", *parts)), "window_end": window["end"], "window_start": window["start"]})
    if not roll_over:
        return out
    # one row for each window; its predecessor is the one that ends where it starts
    windows = out.groupBy("group", "window_start", "window_end").agg(F.min("modified").alias("first"))
    before = windows.select("group", F.col("window_end").alias("window_start"), F.lit(True).alias("_follows"))
    half = F.expr(f"window_start + make_interval(0, 0, 0, 0, 0, 0, {seconds / 2})")
    back = windows.join(before, ["group", "window_start"], "left").where("_follows is null").where(F.col("first") >= half)
    back = back.select("group", "window_end", (F.col("window_start") - F.expr(f"interval {int(seconds)} seconds")).alias("_back"))
    return out.join(back, ["group", "window_end"], "left").withColumn("window_start", F.coalesce("_back", "window_start")).drop("_back")


def due_windows(files: DataFrame, now: Column, delay_seconds: int = 7) -> DataFrame:
    """One row for each window that has ended and settled: its files in order of time and url."""
    closed = files.where(F.col("window_end") + F.expr(f"interval {int(delay_seconds)} seconds") <= now)
    return closed.groupBy("dest", "group", "window_start", "window_end").agg(F.array_sort(F.collect_set(F.struct("modified", "url"))).alias("files"))


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.desc("modified"), F.asc("url"))


def main_extension(files: DataFrame) -> DataFrame:
    """The most frequent extension, ties to the first by name: ext, count."""
    counts = files.groupBy(F.regexp_extract("url", r"\.(\w+)$", 1).alias("ext")).count()
    return counts.orderBy(F.desc("count"), "ext").limit(1)


@dataclass(frozen=True)
class LoadOptions:
    """How files are read. Format comes from the first URL's extension where it isn't set."""

    format: str | None = None
    skip_leading_rows: int = 0
    max_bad_records: int = 0
    allow_jagged_rows: bool = False
    ignore_unknown_values: bool = False
    autodetect: bool = False
    options: dict[str, str] = field(default_factory=dict)

    def format_of(self, urls: list[str]) -> str:
        if self.format:
            return {"NEWLINE_DELIMITED_JSON": "json"}.get(self.format.upper(), self.format.lower())
        first = urls[0].lower()
        for mark, kind in ((".csv", "csv"), (".avro", "avro"), (".parquet", "parquet"), (".orc", "orc")):
            if mark in first:
                return kind
        return "json"


def is_corrupt(rows: DataFrame, options: LoadOptions | None = None) -> Column:
    """Whether a record is bad, judged by all its columns.

    With jagged rows allowed, a CSV record that only lacks columns at its end is none; what
    stands in quotes counts as no delimiter. The condition reads every column: a reader parses
    only columns that are asked for, and Spark refuses a scan of the corrupt record alone.
    """
    fields = [f for f in rows.schema if f.name not in (CORRUPT, SOURCE_URL)]
    plain = [F.size(f.name) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in fields]
    bad = F.col(CORRUPT).isNotNull() & (F.xxhash64(*plain) >= F.lit(-(1 << 63)))
    if options and options.allow_jagged_rows:
        mark, q = (re.escape(options.options.get(k, d)) for k, d in (("FieldDelimiter", ","), ("Quote", '"')))
        unquoted = F.regexp_replace(CORRUPT, f"{q}(?:[^{q}]|{q}{q})*{q}", "q") if q else F.col(CORRUPT)
        bad &= F.regexp_count(unquoted, F.lit(mark)) + 1 >= len(fields)
    return bad


class TooManyBadRecords(ValueError):
    pass


CORRUPT = "_corrupt_record"
#: Where a scan can't offer _metadata, its rows have their file's url in a column.
SOURCE_URL = "_source_url"
#: Lines of a block that are put in order together.
STRETCH = 1 << 16


def scan(spark: SparkSession, urls: list[str], schema: T.StructType | None, options: LoadOptions | None = None) -> DataFrame:
    """Rows of all files in one scan, text formats with a column for records that don't parse."""
    options = options or LoadOptions()
    urls = list(dict.fromkeys(urls))
    kind = options.format_of(urls)
    reader = spark.read.format(kind)
    if kind in ("parquet", "orc"):
        if schema is None:
            return reader.option("mergeSchema", "true").load(urls)
        return reader.schema(schema).load(urls)
    if kind == "avro":
        return (reader if schema is None else reader.schema(schema)).load(urls)
    plain = {CSV_OPTIONS.get(k, k): v for k, v in options.options.items()}
    quoted = plain.get("multiLine", "").lower() == "true"
    if kind == "csv" and (options.skip_leading_rows > 1 or quoted and schema is not None):
        return _csv_records(spark, urls, schema, options.skip_leading_rows, plain, quoted)
    reader = reader.options(**plain)
    if schema is None:
        if kind == "csv":
            reader = reader.option("inferSchema", "true").option("header", str(options.skip_leading_rows > 0).lower())
        return reader.load(urls)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if kind == "csv":
        reader = reader.option("header", str(options.skip_leading_rows > 0).lower()).option("enforceSchema", "true")
    return reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).load(urls)


def _csv_records(spark: SparkSession, urls: list[str], schema: T.StructType | None, skip: int, plain: dict[str, str], quoted: bool) -> DataFrame:
    """CSV rows behind the first records of every file, from lines that are read in blocks.

    Without quoted breaks every line is a record, and only the blocks that hold a file's first ones
    are told where those end: no line is shuffled. With them, the number of quotes before a line says
    whether it begins a record: their parity is summed within stretches of a block, where lines are in
    order, and the stretches before it add theirs, so a record may span blocks, a file is read by
    as many tasks as it has blocks and no sort is of more lines than a stretch has. Lines that are whole
    records go on as they are; only those of broken ones are grouped. A quote within a field without
    quotes counts like any other.
    """
    if schema is None:
        raise ValueError("more than one leading row needs a schema")
    # ids rise within a block, by one from line to line
    lines = spark.read.text(urls).select(
        "value", F.col("_metadata.file_path").alias("_url"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n")
    )
    if quoted:
        records = _quoted_records(lines, skip, plain.get("quote", '"'))
    else:
        blocks = lines.groupBy("_url", "_at").agg(F.min("_n").alias("_from"), F.count("*").alias("_lines"))
        first = F.coalesce(F.sum("_lines").over(Window.partitionBy("_url").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        leading = blocks.withColumn("_first", first).where(F.col("_first") < skip).select("_url", "_at", (F.col("_from") + skip - F.col("_first")).alias("_begin"))
        # about one row for each of the urls, which the driver has
        placed = lines.join(F.broadcast(leading), ["_url", "_at"], "left").where(F.col("_begin").isNull() | (F.col("_n") >= F.col("_begin")))
        records = placed.where("value <> ''").select("_url", "value")
    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv("value", full, {**{k: v for k, v in plain.items() if k != "multiLine"}, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return records.select(parsed.alias("_x"), F.col("_url").alias(SOURCE_URL)).select("_x.*", SOURCE_URL)


def _quoted_records(lines: DataFrame, skip: int, quote: str) -> DataFrame:
    """(_url, value) of the records behind the first ones; lines within quotes are joined."""
    odd = F.regexp_count("value", F.lit(re.escape(quote))) % 2 if quote else F.lit(0)
    stretch = ["_url", "_at", "_part"]
    within = Window.partitionBy(*stretch).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_part", F.floor(F.col("_n") / STRETCH)).withColumn("_odd", odd).withColumn("_quotes", F.sum("_odd").over(within) - F.col("_odd"))
    # a stretch's lines begin records where the quotes before them are even, or odd, as the stretches before are
    begins = lambda even: F.count_if(F.col("_quotes") % 2 == (0 if even else 1))
    parts = lines.groupBy(*stretch).agg(F.sum("_odd").alias("_sum"), begins(True).alias("_even"), begins(False).alias("_uneven"))
    before = Window.partitionBy("_url").orderBy("_at", "_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_state", F.coalesce(F.sum("_sum").over(before), F.lit(0)) % 2)
    first = F.coalesce(F.sum(F.when(F.col("_state") == 0, F.col("_even")).otherwise(F.col("_uneven"))).over(before), F.lit(0))
    parts = parts.select(*stretch, "_state", first.alias("_first"))
    placed = lines.join(parts, stretch).withColumn("_begins", (F.col("_quotes") + F.col("_state")) % 2 == 0)
    placed = placed.withColumn("_record", F.col("_first") + F.sum(F.col("_begins").cast("long")).over(within)).where(F.col("_record") > skip)
    whole = F.col("_begins") & (F.col("_odd") == 0)
    broken = placed.where(~whole).groupBy("_url", "_record").agg(F.array_sort(F.collect_list(F.struct("_at", "_n", "value"))).alias("x"))
    return placed.where(whole & (F.col("value") != "")).select("_url", "value").union(broken.select("_url", F.array_join("x.value", "\n").alias("value")))


def load(spark: SparkSession, urls: list[str], schema: T.StructType | None, options: LoadOptions | None = None, counted: bool = False) -> DataFrame:
    """Rows of the files; raises TooManyBadRecords beyond the bad records that options allow.

    Bad records are counted in one pass over the files, unless they have been, and left out if
    they are few enough.
    """
    options = options or LoadOptions()
    rows = scan(spark, urls, schema, options).drop(SOURCE_URL)
    if CORRUPT not in rows.columns:
        return rows
    bad = is_corrupt(rows, options)
    count = 0 if counted else rows.agg(F.count_if(bad).alias("bad")).first()["bad"]
    if count > options.max_bad_records:
        raise TooManyBadRecords(f"{count} bad records, {options.max_bad_records} are allowed")
    return rows.where(~bad).drop(CORRUPT)
