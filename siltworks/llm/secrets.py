"""Secret scan by multipart credential linking, in DataFrame functions only.

Base spans are patterns that are secrets on their own: assignments of a long value, access
keys and long hexadecimal runs. Weak candidates (short assigned values, clipped access keys,
logins, 40-character keys, endpoints) mean nothing alone, so they are reported only where a
complementary part lies within SCOPE code points, from the end of one to the start of the
other: an identifier or endpoint beside a secret,
a secret beside an identifier or endpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import cut, table

#: Fixed values of the base spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

#: Weak candidates.
CLIPPED = r"(?<![A-Z0-9])AKIA[A-Z0-9]{8,13}(?![A-Z0-9])"
LOGIN = r"""(?i)\b(?:user(?:name)?|login|account(?:_id)?|client_id|access_key(?:_id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
KEY40 = r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
# labels are possessive: a group that gives nothing back is matched in a loop, not by recursion, and
# a host begins only where no character of hosts is before it, so a long dotted run is read once
ENDPOINT = r"""\b[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]+|(?<![A-Za-z0-9_.-])(?:[a-z0-9-]++\.)++[a-z]{2,}+:[0-9]{2,5}\b"""
WEAK_LEAST = 6
SCOPE = 200

#: Order of kinds at equal starts; the first three are the base.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}


#: What is searched for: name, pattern, the group whose length decides, and for each length from
#: so many on, below so many, what a match is.
SEARCHES = [
    ("assign", ASSIGN, 2, [(ASSIGN_LEAST, None, "assign"), (WEAK_LEAST, ASSIGN_LEAST, "weak_secret")]),
    ("access", ACCESS, 0, [(0, None, "access")]),
    ("hex", HEX, 0, [(0, None, "hex")]),
    ("clipped", CLIPPED, 0, [(0, None, "weak_id")]),
    ("login", LOGIN, 0, [(0, None, "weak_id")]),
    ("key40", KEY40, 0, [(0, None, "weak_secret")]),
    ("endpoint", ENDPOINT, 0, [(0, None, "endpoint")]),
]


def steps_of(text: Column, pattern: str, value_group: int) -> Column:
    """Lengths in code points for each leftmost, non-overlapping match: of the gap before it, of itself, of its value."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else hits
    # the last gap, behind all matches, has no match
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
    steps = F.transform(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["value"]).alias("value")),
    )
    none = F.array().cast("array<struct<gap:int,hit:int,value:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), steps).otherwise(none)


def find_parts(found: DataFrame) -> DataFrame:
    """(_row, start, rank, end, kind) of base spans and weak candidates, from rows' steps.

    Starts are running sums over a row's matches of one search, and a candidate that overlaps a
    base span goes; both are windows over rows in order, linear in the number of matches.
    """
    searches = F.array(*[F.struct(F.lit(name).alias("search"), F.col(name).alias("steps")) for name, *_ in SEARCHES])
    each = found.select("_row", F.explode(searches).alias("s")).where(F.size("s.steps") > 0)
    each = each.select("_row", "s.search", F.posexplode("s.steps").alias("pos", "x")).select("_row", "search", "pos", "x.*")
    sofar = Window.partitionBy("_row", "search").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", (F.sum(F.col("gap") + F.col("hit")).over(sofar)).cast("int"))
    kind = F.lit(None).cast("string")
    for name, _, _, lengths in SEARCHES:
        for least, below, what in lengths:
            fits = (F.col("search") == name) & (F.col("value") >= least)
            kind = F.when(fits & (F.col("value") < below) if below else fits, what).otherwise(kind)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = placed.withColumn("kind", kind).where("kind is not null").select("_row", (F.col("end") - F.col("hit")).alias("start"), rank.alias("rank"), "end", "kind")
    before = Window.partitionBy("_row").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("rank"), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    base = F.col("rank") < 3
    met = spans.withColumns({"_before": F.max(F.when(base, F.col("end"))).over(before), "_after": F.min(F.when(base, F.col("start"))).over(after)})
    apart = F.coalesce(F.col("_before") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_after") >= F.col("end"), F.lit(True))
    return met.where(base | apart).drop("_before", "_after")


def link_parts(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans, once each, that have a complementary part of the same row in scope.

    The distance is the gap from the end of one part to the start of the other, 0 if they meet.
    An interval join of parts with parts of the same row on buckets of `scope` code points; a
    part lies in all buckets from its start to its end. Parts of one role in one bucket are
    summed up first by their least start and greatest end, the nearest that a neighbour can
    meet, so a row with many parts makes no pairs of them.
    """
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv]), F.col("kind"))
    bucket = lambda at: F.floor(F.col(at) / scope)
    every = spans.withColumns({"role": role, "low": bucket("start"), "high": bucket("end")})
    marks = (
        every.select("_row", "start", "end", F.col("role").alias("other"), F.explode(F.sequence("low", "high")).alias("bucket"))
        .groupBy("_row", "bucket", "other")
        .agg(F.min("start").alias("first"), F.max("end").alias("last"))
    )
    near = (
        F.when(F.col("bucket") < F.col("low"), F.col("last") >= F.col("start") - scope)
        .when(F.col("bucket") > F.col("high"), F.col("first") <= F.col("end") + scope)
        .otherwise(F.lit(True))
    )
    complementary = (F.col("role") == "secret") != (F.col("other") == "secret")
    weak = every.where(F.col("rank") >= 3).withColumn("bucket", F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1)))
    return weak.join(marks, ["_row", "bucket"]).where(complementary & near).select("_row", "start", "rank", "end", "kind").distinct()


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, base, linked): spans of every row of docs, each an array in order of start and kind.

    Null and empty texts have none; equal ids and repeated rows are scanned each on its own,
    an empty table gives no rows, and whole texts are read whatever their length. The work is
    linear in the text and the number of its spans.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    searched = docs.select(F.col(id_col).alias("_id"), *[steps_of(text, pattern, group).alias(name) for name, pattern, group, _ in SEARCHES])
    found = cut(searched.withColumn("_row", F.monotonically_increasing_id()))
    spans = cut(find_parts(found))
    reported = spans.where("rank < 3").unionByName(link_parts(spans, scope))
    span, base = F.struct("start", "rank", "end", "kind"), F.col("rank") < 3
    some = lambda which, name: F.array_sort(F.collect_list(F.when(which, span))).alias(name)
    lists = reported.groupBy("_row").agg(some(base, "base"), some(~base, "linked"))
    none = F.array().cast(f"array<{SPAN}>")
    joined = found.select("_id", "_row").join(lists, "_row", "left")
    return joined.select(F.col("_id").alias(id_col), F.coalesce("base", none).alias("base"), F.coalesce("linked", none).alias("linked"))


def _rendered(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3(spark, sf_dir: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(_rendered(F.col("base")), 256).alias("base_sha256"),
        _rendered(F.array_sort(F.concat("base", "linked"))).alias("spans"),
    )
