"""Schemas: inference from JSON, merging, comparison and what a table may be changed to."""

from __future__ import annotations

import json

from pyspark.sql import types as T

NAMES = {
    "INT64": T.LongType(), "INTEGER": T.LongType(), "FLOAT64": T.DoubleType(), "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(),
}


def from_fields(fields: list[dict]) -> T.StructType:
    """A Spark schema from fields with name, type, mode (REQUIRED, REPEATED) and nested fields."""
    out = []
    for f in fields:
        low = {k.lower(): v for k, v in f.items()}
        kind = low["type"].upper()
        data = from_fields(low["fields"]) if kind in ("RECORD", "STRUCT") else NAMES[kind]
        mode = (low.get("mode") or "NULLABLE").upper()
        out.append(T.StructField(low["name"], T.ArrayType(data) if mode == "REPEATED" else data, mode != "REQUIRED"))
    return T.StructType(out)


def infer(value) -> T.DataType:
    """Type of a JSON value: a number is a long if it has no fraction, null and [] are strings."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int | float):
        return T.LongType() if value == int(value) else T.DoubleType()
    if isinstance(value, dict):
        return T.StructType([T.StructField(k, infer(v)) for k, v in value.items()])
    if isinstance(value, list):
        kinds = [infer(v) for v in value if v is not None]
        element = kinds[0] if kinds else T.StringType()
        for kind in kinds[1:]:
            element = merge(element, kind)
        return T.ArrayType(element)
    return T.StringType()


def infer_line(line: str) -> T.StructType:
    kind = infer(json.loads(line))
    if not isinstance(kind, T.StructType):
        raise ValueError("a record is a JSON object")
    return kind


def merge(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: fields of both, long widens to double, else string."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        out = {f.name: f for f in a}
        for f in b:
            old = out.get(f.name)
            out[f.name] = T.StructField(f.name, merge(old.dataType, f.dataType), old.nullable or f.nullable) if old else T.StructField(f.name, f.dataType)
        return T.StructType(list(out.values()))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge(a.elementType, b.elementType))
    if a == b:
        return a
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def extended(table: T.DataType, found: T.DataType) -> T.DataType:
    """A table's type with the fields that `found` has besides, at every depth; what it has stays as it is."""
    if isinstance(table, T.StructType) and isinstance(found, T.StructType):
        have = _by_name(found)
        own = [T.StructField(f.name, extended(f.dataType, have[f.name.lower()].dataType) if f.name.lower() in have else f.dataType, f.nullable) for f in table]
        return T.StructType(own + [T.StructField(f.name, f.dataType) for k, f in have.items() if k not in _by_name(table)])
    if isinstance(table, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(extended(table.elementType, found.elementType))
    return table


def _by_name(schema: T.StructType) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in schema}


def _same(a: T.DataType, b: T.DataType) -> bool:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return equal(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _same(a.elementType, b.elementType)
    return a == b


def equal(a: T.StructType, b: T.StructType) -> bool:
    """Same names and types, in any order and at every depth."""
    x, y = _by_name(a), _by_name(b)
    return x.keys() == y.keys() and all(_same(x[k].dataType, y[k].dataType) for k in x)


def patchable(table: T.StructType, template: T.StructType) -> bool:
    """Whether a table can take a template's schema: no column dropped, none of another type."""
    old, new = _by_name(table), _by_name(template)
    return old.keys() <= new.keys() and all(_same(old[k].dataType, new[k].dataType) for k in old)


def can_copy(source: T.StructType, dest: T.StructType) -> bool:
    return _by_name(source).keys() <= _by_name(dest).keys()


def unknown_fields(found: T.DataType, known: T.DataType, prefix: str = "") -> list[str]:
    """Dotted names of fields of `found` that `known` lacks, at every depth."""
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return unknown_fields(found.elementType, known.elementType, prefix)
    if not (isinstance(found, T.StructType) and isinstance(known, T.StructType)):
        return []
    have = _by_name(known)
    out = []
    for f in found:
        if f.name.lower() not in have:
            out.append(prefix + f.name)
        else:
            out += unknown_fields(f.dataType, have[f.name.lower()].dataType, f"{prefix}{f.name}.")
    return out
