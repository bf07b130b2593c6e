"""Telling bad files from good ones, and loading the good ones.

One permissive pass over all files finds every file with bad records at once. A flagged line
that is sound JSON has a schema error, any other is corrupt. Fields that a table lacks, which
a reader drops in silence, are found in the same pass from the schema that each file itself has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import schemas
from siltworks.sources.files import CORRUPT, CSV_OPTIONS, SOURCE_URL, LoadOptions, is_corrupt, scan


@dataclass
class Classified:
    valid: list[str] = field(default_factory=list)
    corrupted: list[str] = field(default_factory=list)
    invalid_schema: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)


def exists(spark: SparkSession, url: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(url)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def missing(spark: SparkSession, urls: list[str]) -> list[str]:
    """The urls that name nothing; many in one folder cost one listing of it, in chunks of the store's."""
    jvm, by_folder = spark._jvm, {}
    for url in urls:
        by_folder.setdefault(url.rpartition("/")[0], []).append(url)
    gone = []
    for folder, own in by_folder.items():
        if len(own) < 3:
            gone += [u for u in own if not exists(spark, u)]
            continue
        path = jvm.org.apache.hadoop.fs.Path(folder or "/")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        wanted, names = {unquote(u.rpartition("/")[2]): u for u in own}, fs.listStatusIterator(path) if fs.exists(path) else None
        while names is not None and wanted and names.hasNext():
            wanted.pop(names.next().getPath().getName(), None)
        # a name that was escaped otherwise than read here is asked for itself
        gone += [u for u in wanted.values() if not exists(spark, u)]
    return sorted(gone, key=urls.index)


def judged(spark: SparkSession, urls: list[str], schema: T.StructType, options: LoadOptions) -> DataFrame:
    """(url, kind, bad, fields) for each file, from one scan of all of them.

    bad is the number of bad records and kind what they make of the file: corrupted or
    invalid_schema. fields is the schema that the file itself has, as a variant's text, merged
    from its lines on the executors; null for CSV. One row a file comes back.
    """
    if options.format_of(urls) == "json":
        full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField(CORRUPT, T.StringType())])
        read = {**{CSV_OPTIONS.get(k, k): v for k, v in options.options.items()}, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        lines = spark.read.text(urls).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("url"))
        parsed = lines.select("url", F.try_parse_json("value").alias("v"), F.from_json("value", full, read).alias("x"))
        rows = parsed.select("url", F.col(f"x.{CORRUPT}").isNotNull().alias("bad"), F.col("v").isNotNull().alias("sound"), "v")
        fields = F.schema_of_variant_agg("v")
    else:
        scanned = scan(spark, urls, schema, options)
        url = F.col(SOURCE_URL if SOURCE_URL in scanned.columns else "_metadata.file_path")
        rows = scanned.select(url.alias("url"), is_corrupt(scanned, options).alias("bad"), F.lit(True).alias("sound"))
        fields = F.lit(None).cast("string")
    found = rows.groupBy("url").agg(F.count_if("bad").alias("bad"), F.count_if(F.col("bad") & ~F.col("sound")).alias("corrupt"), fields.alias("fields"))
    kind = F.when(F.col("corrupt") > 0, "corrupted").when(F.col("bad") > 0, "invalid_schema").alias("kind")
    return found.select("url", kind, "bad", "fields")


#: Words of a variant's schema and the Spark types that stand for them; null alone tells no type.
_VARIANT = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[^\W]+|\s+|.", re.S)


def parse_variant_schema(text: str) -> T.DataType:
    """A Spark type from the text form of a variant's schema; only words where a type stands are changed."""
    if not text:
        return T.NullType()
    tokens = _TOKEN.findall(text)
    after = lambda k: next((t for t in tokens[k + 1 :] if not t.isspace()), "")
    return T._parse_datatype_string("".join(_VARIANT.get(t, t) if after(k) != ":" else t for k, t in enumerate(tokens)))


def _plain(url: str) -> str:
    """A url without the forms that a local one may take and without escapes."""
    return unquote(re.sub(r"^file:/+", "/", url))


def classify(spark: SparkSession, urls: list[str], schema: T.StructType, options: LoadOptions | None = None) -> Classified:
    """Sort the files of a load into valid, corrupted, of invalid schema and missing ones.

    The bad records that options allow are for the load as a whole: files of fewest bad records
    stay valid as long as all that stay hold no more than that.
    """
    options = options or LoadOptions()
    urls = list(dict.fromkeys(urls))
    out = Classified(missing=missing(spark, urls))
    gone = set(out.missing)
    there = [u for u in urls if u not in gone]
    if not there:
        return out
    kind = options.format_of(there)
    if kind in ("parquet", "orc"):
        groups = same_schema(spark, there, kind, lambda found: fits(found, schema, options.ignore_unknown_values))
        out.corrupted = [u for found, urls in groups if found is None for u in urls]
        bad = {u for found, urls in groups if found is not None and not fits(found, schema, options.ignore_unknown_values) for u in urls}
        out.invalid_schema = [u for u in there if u in bad]
        out.valid = [u for u in there if u not in bad and u not in out.corrupted]
        return out
    if kind not in ("json", "csv"):
        out.valid = there
        return out
    given = {_plain(u): u for u in there}
    verdict, allowed = {}, options.max_bad_records
    for r in sorted(judged(spark, there, schema, options).collect(), key=lambda r: (r["bad"], r["url"])):
        url = given.get(_plain(r["url"]), r["url"])
        allowed -= r["bad"]
        if r["bad"] and allowed < 0:
            verdict[url] = r["kind"]
        elif r["fields"] and not options.ignore_unknown_values and schemas.unknown_fields(parse_variant_schema(r["fields"]), schema):
            verdict[url], allowed = "invalid_schema", allowed + r["bad"]
    for url in there:
        getattr(out, verdict.get(url, "valid")).append(url)
    return out


def same_schema(spark: SparkSession, urls: list[str], kind: str, well=lambda found: True) -> list[tuple[T.StructType | None, list[str]]]:
    """(merged schema, files) of groups whose schemas merge into one that is well; None for a file without a footer.

    Spark reads the footers of a group on the executors, in one job. A group that doesn't merge, or
    not well, is halved, so one unfit file costs as many jobs as its group has halves.
    """
    try:
        found = spark.read.option("mergeSchema", "true").format(kind).load(urls).schema
    except Exception:
        if len(urls) == 1:
            return [(None, urls)]
        found = None
    if len(urls) == 1 or found is not None and well(found):
        return [(found, urls)]
    half = len(urls) // 2
    return [g for part in (urls[:half], urls[half:]) for g in same_schema(spark, part, kind, well)]


#: What a reader takes for a column of the type on the left.
WIDER = {
    T.LongType: (T.IntegerType, T.ShortType, T.ByteType), T.IntegerType: (T.ShortType, T.ByteType), T.ShortType: (T.ByteType,),
    T.DoubleType: (T.FloatType, T.IntegerType, T.ShortType, T.ByteType), T.TimestampType: (T.TimestampNTZType,), T.TimestampNTZType: (T.DateType,),
}


def fits(found: T.DataType, wanted: T.DataType, unknown_too: bool = False) -> bool:
    """Whether a file's type can be read as a table's: no type that isn't the same or narrower, and no field that the table lacks."""
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name.lower(): f.dataType for f in wanted}
        return all(fits(f.dataType, have[f.name.lower()], unknown_too) if f.name.lower() in have else unknown_too for f in found)
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return fits(found.elementType, wanted.elementType, unknown_too)
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType):
        return fits(found.keyType, wanted.keyType, unknown_too) and fits(found.valueType, wanted.valueType, unknown_too)
    return found == wanted or isinstance(found, WIDER.get(type(wanted), ()))


def new_fields(spark: SparkSession, urls: list[str], schema: T.StructType, options: LoadOptions | None = None) -> T.StructType:
    """The schema with the fields that the files have besides, at every depth, whatever their format.

    Of columns that the table has, its own types stay; what a file has of another type is no
    reason to change them. CSV columns have no names, so there are none to add.
    """
    options = options or LoadOptions()
    kind = options.format_of(urls) if urls else "csv"
    if kind in ("parquet", "orc"):
        found = [g for g, _ in same_schema(spark, urls, kind, lambda g: fits(g, schema, True)) if g is not None and fits(g, schema, True)]
    elif kind == "json":
        found = [spark.read.json(urls).schema]
    else:
        return schema
    for one in found:
        wanted = [f for f in one if f.name != CORRUPT]
        schema = schemas.extended(schema, T.StructType(wanted))
    return schema
