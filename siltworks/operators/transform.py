"""From loaded rows to rows of the destination: projection, dedupe, side inputs, criteria."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.dialect import to_spark


@dataclass(frozen=True)
class SideInput:
    """A lookup joined to the loaded rows, by table or by a query, left unless `inner`."""

    alias: str
    on: str
    table: str | None = None
    query: str | None = None
    inner: bool = False

    def rows(self, spark: SparkSession) -> DataFrame:
        if self.query:
            return spark.sql(to_spark(self.query))
        return spark.table(self.table)


def join_side_inputs(df: DataFrame, sides: list[tuple[SideInput, DataFrame]]) -> DataFrame:
    """Join the sides in order; a later condition may use earlier aliases.

    A side with repeated keys repeats rows. Catalyst chooses the strategy: a small side is
    broadcast by its measured size, a large one is shuffled.
    """
    for side, rows in sides:
        df = df.join(rows.alias(side.alias), F.expr(to_spark(side.on)), "inner" if side.inner else "left")
    return df


def projection(
    source: T.StructType, transform: dict[str, str] | None = None, dest: T.StructType | None = None, alias: str = "t"
) -> list[tuple[str, str]]:
    """(column, expression): the source's columns in order, then transforms of new columns by name.

    A transform replaces the column it names, whatever its case. With a destination's schema,
    columns that it lacks are left out.
    """
    transform = dict(transform or {})
    lower = {k.lower(): k for k in transform}
    known = None if dest is None else {f.name.lower() for f in dest}
    out = []
    for f in source:
        key = f.name if f.name in transform else lower.get(f.name.lower())
        if known is not None and f.name.lower() not in known:
            if key is not None:
                transform.pop(key)
            continue
        out.append((f.name, to_spark(transform.pop(key)) if key is not None else f"{alias}.`{f.name}`"))
    return out + [(k, to_spark(transform[k])) for k in sorted(transform) if known is None or k.lower() in known]


def select_all(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in columns])


def dedupe_max(df: DataFrame, keys: list[str], columns: list[tuple[str, str]], alias: str = "t") -> DataFrame:
    """One row for each key, every other column the maximum of its expression.

    Columns are taken one by one, nulls skipped, so a row may combine values of several
    duplicates. Partial maxima are taken before the shuffle.
    """
    unique = {k.lower() for k in keys}
    named = {c.lower(): c for c, _ in columns}
    by = [F.expr(f"{alias}.`{named.get(k.lower(), k)}`").alias(named.get(k.lower(), k)) for k in keys]
    out = df.groupBy(*by).agg(*[F.max(F.expr(e)).alias(c) for c, e in columns if c.lower() not in unique])
    return out.select(*[c for c, _ in columns])


def dedupe_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One whole row for each key: the first by `order`, or by all columns that have an order."""
    unique = {k.lower() for k in keys}
    by = order or [f"`{f.name}`" for f in df.schema if f.name.lower() not in unique and not isinstance(f.dataType, T.MapType)]
    w = Window.partitionBy(*keys).orderBy(*[F.expr(o) for o in by] or [F.lit(1)])
    return df.withColumn("row_number", F.row_number().over(w)).where("row_number = 1").drop("row_number")


def is_nested(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType) for f in schema)


def transform(
    df: DataFrame,
    *,
    keys: list[str] | None = None,
    columns: dict[str, str] | None = None,
    sides: list[tuple[SideInput, DataFrame]] | None = None,
    dest: T.StructType | None = None,
    criteria: str | None = None,
    order: list[str] | None = None,
    alias: str = "t",
) -> DataFrame:
    """Rows for the destination from the loaded rows.

    Criteria filter first, side inputs join next. Without unique keys all columns are projected;
    with keys a flat schema is deduped by maxima after the joins, and one with arrays or
    structs by whole rows before them.
    """
    for key in keys or []:
        if key.lower() in {c.lower() for c in columns or {}}:
            raise ValueError(f"unique column {key} has a transform")
    chosen = projection(df.schema, columns, dest, alias)
    nested = bool(keys) and is_nested(df.schema)
    if criteria:
        df = df.alias(alias).where(F.expr(to_spark(criteria)))
    if nested:
        df = dedupe_first(df, keys, order)
    df = join_side_inputs(df.alias(alias), sides or [])
    return dedupe_max(df, keys, chosen, alias) if keys and not nested else select_all(df, chosen)
