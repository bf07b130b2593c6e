"""UPDATE, DELETE and MERGE on tables of files, by writing partitions anew.

Spark parses the statement. Its rows are found by a filter or a join; only the partitions that hold
a row to be changed are read whole and written again, and the new files take the place of the old
in one recorded change. Rows for other partitions are added to them. A statement that changes
nothing writes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import commit, publish

STATEMENTS = ("DeleteFromTable", "UpdateTable", "MergeIntoTable")


class SeveralMatches(ValueError):
    """Two rows of a MERGE's source are for one row of its target."""


@dataclass(frozen=True)
class Clause:
    """What happens to a row: delete it, or set columns to expressions, all of them by name with "*"."""

    action: str
    condition: str | None = None
    values: tuple[tuple[str, str], ...] | str = ()


def parsed(spark: SparkSession, sql: str):
    """Spark's own form of a statement, or None if it is none of STATEMENTS."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    return plan if plan.getClass().getSimpleName() in STATEMENTS else None


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _relation(plan) -> tuple[str, str | None]:
    """Table and alias of a statement's target."""
    alias = None
    if plan.getClass().getSimpleName() == "SubqueryAlias":
        alias, plan = plan.alias(), plan.child()
    if plan.getClass().getSimpleName() != "UnresolvedRelation":
        raise ValueError("a statement changes a table by its name")
    return ".".join(_items(plan.multipartIdentifier())), alias


def _values(action) -> tuple[tuple[str, str], ...] | str:
    name = action.getClass().getSimpleName()
    if "Star" in name:
        return "*"
    if name == "DeleteAction":
        return ()
    return tuple((a.key().sql().rpartition(".")[2].strip("`"), a.value().sql()) for a in _items(action.assignments()))


def _clauses(actions) -> list[Clause]:
    out = []
    for a in _items(actions):
        kind = a.getClass().getSimpleName().removesuffix("Action").removesuffix("Star").lower()
        out.append(Clause(kind, a.condition().get().sql() if a.condition().isDefined() else None, _values(a)))
    return out


def run(spark: SparkSession, sql: str) -> bool:
    """Run an UPDATE, DELETE or MERGE; False if the statement is something else."""
    plan = parsed(spark, sql)
    if plan is None:
        return False
    kind = plan.getClass().getSimpleName()
    if kind == "MergeIntoTable":
        table, alias = _relation(plan.targetTable())
        source = plan.sourceTable()
        name = source.alias() if source.getClass().getSimpleName() == "SubqueryAlias" else _relation(source)[0].rpartition(".")[2]
        rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, source), spark)
        merge(spark, table, rows, plan.mergeCondition().sql(), _clauses(plan.matchedActions()), _clauses(plan.notMatchedActions()), _clauses(plan.notMatchedBySourceActions()), alias, name)
        return True
    table, alias = _relation(plan.table())
    if kind == "DeleteFromTable":
        change_rows(spark, table, plan.condition().sql(), None, alias)
    else:
        set_ = tuple((a.key().sql().rpartition(".")[2].strip("`"), a.value().sql()) for a in _items(plan.assignments()))
        change_rows(spark, table, plan.condition().get().sql() if plan.condition().isDefined() else None, set_, alias)
    return True


def recover(spark: SparkSession, table: str) -> None:
    """Finish what a lost driver recorded and didn't finish."""
    records = commit.Commits(spark, f"{commit.location(spark, table)}/{commit.RECORDS}")
    for name in records.files.data(records.folder):
        if name.startswith("dml-") and (record := records.find(name.removesuffix(".json"))):
            records.finish(record)
            records.forget(name.removesuffix(".json"))


def _write(spark: SparkSession, rows: DataFrame, table: str, touched: DataFrame) -> None:
    change = commit.stage(rows, table, commit.TOUCHED, touched=touched)
    records, event = commit.Commits(spark, f"{commit.location(spark, table)}/{commit.RECORDS}"), f"dml-{uuid.uuid4().hex}"
    records.publish(event, [change])
    records.forget(event)


def _partitions(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame | None:
    """Partitions that rows are of, as a small table of values; of a table without partitions one row if there are rows."""
    by = publish.partition_columns(spark, table)
    if not by:
        return None if rows.isEmpty() else spark.range(1).toDF("_any")
    found = rows.select(*by).distinct()
    values = found.collect()
    return spark.createDataFrame(values, found.schema) if values else None


def _within(spark: SparkSession, table: str, rows: DataFrame, touched: DataFrame) -> DataFrame:
    by = publish.partition_columns(spark, table)
    if not by:
        return rows
    some = touched.select(*[F.col(c).alias(f"_p_{c}") for c in by])
    same = [rows[c].eqNullSafe(some[f"_p_{c}"]) for c in by]
    return rows.join(F.broadcast(some), same, "left_semi")  # one row a partition


def change_rows(spark: SparkSession, table: str, condition: str | None, values: tuple[tuple[str, str], ...] | None, alias: str | None = None) -> None:
    """UPDATE (with values) or DELETE (without) the rows that meet a condition; null is no yes."""
    recover(spark, table)
    _known(spark, table, [c for c, _ in values or ()])
    whole = spark.table(table).alias(alias or table.rpartition(".")[2])
    hit = F.coalesce(F.expr(condition), F.lit(False)) if condition else F.lit(True)
    touched = _partitions(spark, table, whole.where(hit))
    if touched is None:
        return
    rows = _within(spark, table, whole, touched)
    if values is None:
        rows = rows.where(~hit)
    else:
        new = {c.lower(): F.expr(v) for c, v in values}
        rows = rows.select(*[F.when(hit, new[c.lower()]).otherwise(F.col(f"`{c}`")).alias(c) if c.lower() in new else F.col(f"`{c}`") for c in whole.columns])
    _write(spark, rows, table, touched)


def _known(spark: SparkSession, table: str, names) -> None:
    have = {c.lower() for c in spark.table(table).columns}
    if lost := [n for n in names if n.lower() not in have]:
        raise ValueError(f"{table} has no column {lost[0]}")


def merge(
    spark: SparkSession, table: str, source: DataFrame, on: str, matched: list[Clause], not_matched: list[Clause] = (), not_by_source: list[Clause] = (),
    target_alias: str | None = None, source_alias: str = "s",
) -> None:
    """MERGE rows of a source into a table, each row by the first of its clauses whose condition it meets.

    Two source rows for one target row are an error, before anything is written. Rows for which no
    clause is meant stay as they are, or out.
    """
    recover(spark, table)
    t, columns = target_alias or table.rpartition(".")[2], spark.table(table).columns
    names = {c.lower() for c in source.columns}
    for clause in (*matched, *not_matched, *not_by_source):
        _known(spark, table, [] if clause.values == "*" else [c for c, _ in clause.values])
    own = spark.table(table)
    whole = own.withColumn("_own", F.lit(True)).alias(t)
    given = source.withColumn("_given", F.lit(True)).alias(source_alias)
    by = publish.partition_columns(spark, table)
    numbered = own.withColumn("_n", F.monotonically_increasing_id()).alias(t)
    pairs = numbered.join(given, F.expr(on)).select(*[F.col(f"{t}.`{c}`").alias(c) for c in by], F.col(f"{t}._n").alias("_n"))
    counted = pairs.groupBy(*by, "_n").agg(F.count("*").alias("_m")).groupBy(*by).agg(F.max("_m").alias("_m"))
    found = counted.collect()  # one row a partition
    if any((r["_m"] or 0) > 1 for r in found):
        raise SeveralMatches(f"two source rows for one row of {table}")
    found = [r for r in found if r["_m"]]
    if not_by_source:
        touched = _partitions(spark, table, own)
    elif not found:
        touched = None
    else:
        touched = spark.createDataFrame([tuple(r[c] for c in by) for r in found], own.select(*by).schema) if by else spark.range(1).toDF("_any")
    base = _within(spark, table, own, touched) if touched is not None else own.limit(0)
    joined = base.withColumn("_own", F.lit(True)).alias(t).join(given, F.expr(on), "full")
    both, mine, theirs = F.col("_own") & F.col("_given"), F.col("_own") & F.col("_given").isNull(), F.col("_own").isNull()
    steps: list[tuple[Column, Clause | None]] = []
    for side, clauses in ((both, matched), (mine, not_by_source), (theirs, not_matched)):
        steps += [(side & (F.coalesce(F.expr(c.condition), F.lit(False)) if c.condition else F.lit(True)), c) for c in clauses]
    chosen = F.lit(None).cast("int")
    for k, (meets, _) in reversed(list(enumerate(steps))):
        chosen = F.when(F.coalesce(meets, F.lit(False)), k).otherwise(chosen)
    # a step's number stands for its clause; rows without one stay if they are the table's
    drops = [k for k, (_, c) in enumerate(steps) if c.action == "delete"]
    out = []
    for c in columns:
        value = F.col(f"{t}.`{c}`")
        for k, (_, clause) in enumerate(steps):
            if clause.action == "delete":
                continue
            new = {n.lower(): F.expr(v) for n, v in clause.values} if clause.values != "*" else {c.lower(): F.col(f"{source_alias}.`{c}`")} if c.lower() in names else {}
            if c.lower() in new:
                value = F.when(F.col("_step") == k, new[c.lower()]).otherwise(value)
        out.append(value.alias(c))
    placed = joined.withColumn("_step", chosen).where((F.col("_own") & F.col("_step").isNull()) | F.col("_step").isNotNull())
    rows = (placed.where(F.col("_step").isNull() | ~F.col("_step").isin(drops)) if drops else placed).select(*out)
    if touched is None and not not_matched:
        return
    _write(spark, rows, table, touched if touched is not None else own.limit(0))
