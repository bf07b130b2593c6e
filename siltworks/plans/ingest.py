"""One ingestion: files through a rule into its tables, then its actions, noted in a journal."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.naming import SourceFile, TableRef, Variables, expand, parameters
from siltworks.operators import commit, publish
from siltworks.operators.commit import Change, Commits
from siltworks.operators.transform import transform
from siltworks.plans.journal import Journal, LoadMetrics
from siltworks.plans.rule import MAX_RELOAD, Action, Rule
from siltworks.sources import recovery
from siltworks.sources.files import LoadOptions, load

@dataclass
class Context:
    """What actions see: session, variables, outside services, open groups and the table that keeps them."""

    spark: SparkSession
    variables: Variables = field(default_factory=Variables)
    services: dict[str, Callable[[dict], dict | None]] = field(default_factory=dict)
    groups: dict[str, int] = field(default_factory=dict)
    opened: dict[str, datetime] = field(default_factory=dict)
    group_table: str | None = None
    warnings: list[str] = field(default_factory=list)


def _each_file(urls: list[str] | str, run: Callable[[str], None], ctx: Context) -> None:
    """Work on files side by side; what fails is noted as a warning."""
    urls = urls.split(",") if isinstance(urls, str) else urls

    def one(url: str) -> None:
        try:
            run(url)
        except Exception as e:  # any file system's error
            ctx.warnings.append(f"{url}: {e}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(one, dict.fromkeys(u for u in urls if u)))


def _fs(ctx: Context, url: str):
    path = ctx.spark._jvm.org.apache.hadoop.fs.Path(url)
    return path.getFileSystem(ctx.spark._jsc.hadoopConfiguration()), path


def _delete(ctx: Context, r: dict) -> None:
    def run(url: str) -> None:
        fs, path = _fs(ctx, url)
        fs.delete(path, True)

    _each_file(r["urls"], run, ctx)


def _move(ctx: Context, r: dict) -> None:
    def run(url: str) -> None:
        fs, path = _fs(ctx, url)
        _, folder = _fs(ctx, r["desturl"])
        fs.mkdirs(folder)
        if not fs.rename(path, ctx.spark._jvm.org.apache.hadoop.fs.Path(folder, path.getName())):
            raise OSError("not moved")

    _each_file(r["urls"], run, ctx)


def _name(table: str) -> str:
    return TableRef.parse(table).name if "." in table else table


def _copy(ctx: Context, r: dict) -> None:
    if r.get("multipartition") or r.get("partitionsql"):
        of = None
        if "$PartitionID" in r["dest"] or "${PartitionID}" in r["dest"]:
            of = lambda v: _name(r["dest"].replace("${PartitionID}", _partition_id(v)).replace("$PartitionID", _partition_id(v)))
        source = TableRef.parse(r["source"].split("$")[0])
        values = {"Source": {"ProjectID": source.project or "", "DatasetID": source.dataset, "TableID": source.table}}
        sql = Variables(values).put(r["partitionsql"]) if r.get("partitionsql") else None
        publish.copy_partitions(ctx.spark, source.name, "" if of else _name(r["dest"]), of, sql)
        return
    publish.copy(ctx.spark, r["source"], _name(r["dest"]), bool(r.get("append")), r.get("template"))


def _partition_id(value) -> str:
    return value.strftime("%Y%m%d") if hasattr(value, "strftime") else str(value)


#: Rows of a query that a response holds itself.
FETCHED = 10_000
#: Seconds for which a response's table is kept.
RESPONSE_SECONDS = 86_400


def _query(ctx: Context, r: dict) -> dict | None:
    """Run a query; without a destination its rows are the response, the first one by itself too.

    Beyond FETCHED rows, Rows has the first ones, and the table named by RowsTable has all of
    them, for later actions' SQL or for `pages`; it may be swept a day later.
    """
    rows = publish.query(ctx.spark, r["sql"], _name(r["dest"]) if r.get("dest") else None, bool(r.get("append")), r.get("template"))
    if rows is None or not rows.columns:
        return None
    found = [x.asDict(recursive=True) for x in rows.take(FETCHED + 1)]
    if len(found) <= FETCHED:
        return {"Data": found[0], "Rows": found} if found else {"Rows": []}
    table = f"{ctx.spark.catalog.currentDatabase()}.response_{uuid.uuid4().hex}"
    rows.write.format("parquet").saveAsTable(table)
    publish.set_expiry(ctx.spark, table, RESPONSE_SECONDS)
    return {"Data": found[0], "Rows": found[:FETCHED], "RowsTable": table}


def pages(spark: SparkSession, table: str, size: int = FETCHED) -> Iterator[list[dict]]:
    """The rows of a response's table, a page at a time; the driver holds one partition and one page."""
    page: list[dict] = []
    for row in spark.table(table).toLocalIterator():
        page.append(row.asDict(recursive=True))
        if len(page) == size:
            yield page
            page = []
    if page:
        yield page


def _export(ctx: Context, r: dict) -> None:
    df = ctx.spark.table(_name(r["source"]))
    publish.export(df, r["desturl"], r.get("format"), r.get("compression"), bool(r.get("includeheader", True)), r.get("fielddelimiter") or ",")


def _insert(ctx: Context, r: dict) -> None:
    publish.insert(ctx.spark, r.get("sql") or r["rows"], _name(r["dest"]), r.get("template"))


GROUPS = "id string, size long, member string, at timestamp"


def open_group(ctx: Context, key: str, size: int, at: datetime | None = None) -> None:
    """Begin a group of so many members; where the context has a table for groups, it is noted there."""
    at = at or datetime.now(timezone.utc)
    if ctx.group_table:
        if not publish.exists(ctx.spark, ctx.group_table):
            publish.create(ctx.spark, ctx.group_table, T._parse_datatype_string(GROUPS))
        ctx.spark.createDataFrame([(key, size, None, at)], GROUPS).write.insertInto(ctx.group_table)
    ctx.groups[key], ctx.opened[key] = size, at


def _group(ctx: Context, r: dict) -> dict:
    """Count one member of a group as done; the last one lets the nested actions run, once.

    With a table for groups, members are rows of it, so runs on several drivers meet there, and
    a member that reports twice counts once. With `maxdurationinsec`, a member that reports when
    the group has been open for longer is as good as the last one.
    """
    key, now = str(r.get("id") or r.get("groupid")), datetime.now(timezone.utc)
    over = lambda opened: bool(r.get("maxdurationinsec")) and opened is not None and (now - opened).total_seconds() > float(r["maxdurationinsec"])
    if ctx.group_table and publish.exists(ctx.spark, ctx.group_table):
        member = str(r.get("member") or ctx.variables.values.get("EventID") or uuid.uuid4().hex)
        ctx.spark.createDataFrame([(key, None, member, now)], GROUPS).write.insertInto(ctx.group_table)
        ctx.spark.catalog.refreshTable(ctx.group_table)
        opened = F.unix_micros(F.min(F.when(F.col("size").isNotNull(), F.col("at"))))
        state = ctx.spark.table(ctx.group_table).where(F.col("id") == key).agg(F.max("size").alias("size"), F.count_distinct("member").alias("done"), opened.alias("opened")).first()
        since = datetime.fromtimestamp(state["opened"] / 1e6, timezone.utc) if state["opened"] is not None else None
        if state["done"] < (state["size"] or 1) and not over(since):
            return {"Done": False}
        # of all that see it complete, one makes the mark and goes on
        mark = f"{commit.location(ctx.spark, ctx.group_table)}/_ran/{hashlib.sha1(key.encode()).hexdigest()}.json"
        return {"Done": commit.Files(ctx.spark).create(mark, key)}
    ctx.groups[key] = ctx.groups.get(key, 1) - 1
    return {"Done": ctx.groups[key] == 0 or (ctx.groups[key] > 0 and over(ctx.opened.get(key)))}


def _service(name: str):
    def run(ctx: Context, r: dict) -> dict | None:
        if name not in ctx.services:
            raise KeyError(f"no service for {name}")
        return ctx.services[name](r)

    return run


REGISTRY: dict[str, Callable[[Context, dict], dict | None]] = {
    "copy": _copy,
    "query": _query,
    "export": _export,
    "insert": _insert,
    "drop": lambda ctx, r: publish.drop(ctx.spark, _name(r["table"])),
    "tableExists": lambda ctx, r: {"Exists": publish.exists(ctx.spark, _name(r["table"]))},
    "group": _group,
    "move": _move,
    "delete": _delete,
    **{name: _service(name) for name in ("notify", "call", "push")},
}


def run_actions(actions: list[Action], ctx: Context) -> None:
    """Run actions in order, each with what follows its success or failure.

    Fields of an action's response are variables of those after it in its list. A failure
    without actions of its own is raised after the list's other variables are set.
    """
    for action in actions:
        if action.when_exists and not publish.exists(ctx.spark, _name(ctx.variables.put(action.when_exists))):
            continue
        request = ctx.variables.put_all(action.request)
        try:
            response = (load_action if action.name in ("load", "reload") else REGISTRY[action.name])(ctx, request)
        except Exception as e:
            if not action.on_failure:
                raise
            ctx.variables.values["Error"] = str(e)
            run_actions(action.on_failure, ctx)
            continue
        ctx.variables.values |= response or {}
        if not (action.name == "group" and not response["Done"]):
            run_actions(action.on_success, ctx)


def load_action(ctx: Context, r: dict) -> dict:
    """Load files into a table. A load that fails is tried again with the files that are valid then.

    At most `maxreload` more attempts are made; a failure that no file explains is raised.
    """
    urls = r["sourceuris"] if isinstance(r["sourceuris"], list) else r["sourceuris"].split(",")
    dest, options = _name(r["dest"]), r.get("options") or LoadOptions(r.get("sourceformat"), int(r.get("skipleadingrows") or 0), int(r.get("maxbadrecords") or 0), bool(r.get("allowjaggedrows")))
    schema = ctx.spark.table(dest).schema if publish.exists(ctx.spark, dest) else None
    left, attempts = urls, int(r.get("maxreload", MAX_RELOAD))
    while True:
        try:
            rows = load(ctx.spark, left, schema, options)
            break
        except Exception:
            found = recovery.classify(ctx.spark, left, schema, options) if schema is not None else recovery.Classified(missing=recovery.missing(ctx.spark, left))
            valid = found.valid if schema is not None else [u for u in left if u not in found.missing]
            if attempts <= 0 or not valid or len(valid) == len(left):
                raise
            left, attempts = valid, attempts - 1
    publish.write(rows, dest, bool(r.get("append", True)))
    return {"Loaded": left, "Rejected": [u for u in urls if u not in left]}


@dataclass
class Outcome:
    dest: str
    rows_from: list[str]
    corrupted: list[str]
    invalid_schema: list[str]
    missing: list[str]
    skipped: bool = False


def ingest(spark: SparkSession, rule: Rule, files: list[SourceFile], event_id: str, journal: Journal | None = None, ctx: Context | None = None) -> Outcome:
    """Load files of one batch, transform and publish them, and run the rule's actions.

    Names and parameters come from the first file, as one batch has one destination. Files
    that don't fit are left out and reported; with field addition the table takes new fields
    first. With a journal, an event has all its rows in all its tables or none, and once: rows are
    staged, a record makes the change, and a run that finds the record of an earlier one finishes
    it and goes on to the actions. An event that the journal has as done is skipped, so a run may
    be repeated wherever it ended. Of drivers that take up one event at once, one gets its claim.
    """
    ctx = ctx or Context(spark)
    first, urls = files[0], list(dict.fromkeys(f.url for f in files))
    dest = _name(rule.destination(first))
    if journal and (journal.done(event_id) or not journal.claim(event_id)):
        return Outcome(dest, [], [], [], [], skipped=True)
    if journal:
        journal.put(event_id, rule.name, dest, "running", urls)
    temp = f"{TableRef.parse(dest).table}_{event_id}"
    ctx.variables.values |= {
        "EventID": event_id, "DestTable": dest, "TempTable": temp, "JobSource": temp if rule.transient else dest, "RuleURL": rule.name,
        "URLs": ",".join(urls), "LoadURIs": urls, "DollarSign": "$", "Date": first.modified.astimezone(timezone.utc).strftime("%Y%m%d"),
        **parameters(rule.params, rule.pattern, first.path),
    }
    put = lambda text: expand(ctx.variables.put(text), first, rule.pattern, rule.params)
    commits = Commits(spark, journal.commits if journal else None)
    try:
        schema = _known_schema(spark, rule, dest)
        record = commits.find(event_id)
        if record:
            found = recovery.Classified(**record["outcome"])
            if rule.transient and found.valid:
                load(spark, found.valid, schema, rule.options, counted=True).createOrReplaceTempView(temp)
            commits.finish(record)
        else:
            found, changes, metrics = _staged(spark, rule, urls, schema, dest, temp, put)
            commits.publish(event_id, changes, asdict(found))
            if journal:
                journal.put(event_id, rule.name, dest, "published", found.valid)
                journal.note_load(event_id, rule.name, dest, found, metrics)
        if found.valid and rule.expiry_seconds:
            publish.set_expiry(spark, dest, rule.expiry_seconds)
        run_actions(rule.on_success, ctx)
    except Exception as e:
        if journal:
            journal.put(event_id, rule.name, dest, "failed", urls, str(e)[:2000])
        ctx.variables.values["Error"] = str(e)
        run_actions(rule.on_failure, ctx)
        raise
    finally:
        if journal:
            journal.release(event_id)
        if rule.transient:
            spark.catalog.dropTempView(temp)
    if journal:
        journal.put(event_id, rule.name, dest, "done", found.valid)
    return Outcome(dest, found.valid, found.corrupted, found.invalid_schema, found.missing)


def _known_schema(spark: SparkSession, rule: Rule, dest: str) -> T.StructType | None:
    template = rule.transient_template or rule.template
    if rule.autodetect or not (template or publish.exists(spark, dest)):
        return None
    return spark.table(_name(template) if template else dest).schema


def _staged(spark: SparkSession, rule: Rule, urls: list[str], schema: T.StructType | None, dest: str, temp: str, put: Callable[[str], str]) -> tuple[recovery.Classified, list[Change], LoadMetrics]:
    """The files that load, the changes that publish them, with rows written but not to be seen, and what the writes counted."""
    found, metrics = recovery.Classified(valid=urls), LoadMetrics()
    if schema is not None:
        if rule.allow_field_addition:
            gone = set(recovery.missing(spark, urls))
            schema = recovery.new_fields(spark, [u for u in urls if u not in gone], schema, rule.options)
        found = recovery.classify(spark, urls, schema, rule.options)
    attempts = rule.max_reload
    while found.valid:
        try:
            rows = metrics.counted(load(spark, found.valid, schema, rule.options, counted=schema is not None))
            if rule.allow_field_addition and schema is not None and publish.exists(spark, dest):
                publish.patch(spark, dest, schema)
            return found, _changes(spark, rule, rows, dest, temp, put), metrics
        except Exception:
            # a file may have gone or changed since it was judged
            again = recovery.classify(spark, found.valid, schema, rule.options) if schema is not None else None
            if again is None or attempts <= 0 or again.valid == found.valid:
                raise
            attempts -= 1
            found = recovery.Classified(again.valid, found.corrupted + again.corrupted, found.invalid_schema + again.invalid_schema, found.missing + again.missing)
    return found, [], metrics


def _changes(spark: SparkSession, rule: Rule, rows: DataFrame, dest: str, temp: str, put: Callable[[str], str]) -> list[Change]:
    if rule.template and not rule.split:
        publish.ensure(spark, dest, _name(rule.template))
    if rule.transient:
        rows.createOrReplaceTempView(temp)
    if rule.split:
        rows = publish.split_columns(rows, rule.cluster, rule.time_column)
        by = ([rule.time_column] if rule.time_column else []) + [c.rpartition(".")[2] for c in rule.cluster]
        rows = publish.clustered(rows, by) if by else rows
        return commit.stage_split(rows, [(put(w), _name(put(t))) for w, t in rule.split], rule.append, _name(rule.template) if rule.template else None, rule.allow_field_relaxation)
    if rule.transforms or rule.criteria:
        known = spark.table(dest).schema if publish.exists(spark, dest) else None
        sides = [(s, s.rows(spark)) for s in rule.sides]
        columns = {k: put(v) for k, v in rule.transform.items()}
        rows = transform(rows, keys=rule.unique, columns=columns, sides=sides, dest=known, criteria=put(rule.criteria) if rule.criteria else None, order=rule.order or None, alias=rule.alias)
    partition, only = TableRef.parse(rule.table).partition if rule.table else None, None
    if partition and publish.exists(spark, dest):
        key = publish.partition_columns(spark, dest)[0]
        value = put(partition)
        kind = dict(spark.table(dest).dtypes)[key]
        only = {key: datetime.strptime(value, "%Y%m%d").date() if kind == "date" else value}
    mode = commit.APPEND if rule.append else commit.PARTITIONS if partition else commit.OVERWRITE
    return [commit.stage(rows, dest, mode, only, relax=rule.allow_field_relaxation)]
