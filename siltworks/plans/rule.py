"""Rules: what to match, how to batch, where to publish and what to do then."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.naming import Param, SourceFile, expand, expanded, groups_of
from siltworks.operators.transform import SideInput
from siltworks.sources.files import LoadOptions, Match

#: Defaults and limits of batches and reloads.
WINDOW_SECONDS = 95
WINDOW_LEAST = 10
MAX_RELOAD = 15
NESTABLE = {"load", "reload", "copy", "query", "export", "insert", "drop", "group", "call", "push"}
ACTIONS = NESTABLE | {"tableExists", "move", "delete", "notify"}


class InvalidRule(ValueError):
    pass


def read_text(url: str) -> str:
    """A small text file, from any store that the session reads, or a local one without a session."""
    if (spark := SparkSession.getActiveSession()) is not None:
        return spark.read.text(url, wholetext=True).first()[0]
    with open(url) as f:
        return f.read()


@dataclass
class Action:
    name: str
    request: dict = field(default_factory=dict)
    when_exists: str | None = None
    on_success: list[Action] = field(default_factory=list)
    on_failure: list[Action] = field(default_factory=list)

    @classmethod
    def load(cls, raw: dict) -> Action:
        raw = _lower(raw)
        out = cls(
            raw["action"],
            _lower(raw.get("request") or {}),
            _lower(raw.get("when") or {}).get("exists"),
            [cls.load(a) for a in raw.get("onsuccess") or []],
            [cls.load(a) for a in raw.get("onfailure") or []],
        )
        for key in ("sql", "body"):
            if url := out.request.get(f"{key}url"):
                out.request[key] = read_text(url)
        if out.name in ("delete", "move") and not out.request.get("urls"):
            out.request["urls"] = "$LoadURIs"
        out.validate()
        return out

    def validate(self) -> None:
        if self.name not in ACTIONS:
            raise InvalidRule(f"unknown action {self.name}")
        if self.name not in NESTABLE and (self.on_success or self.on_failure):
            raise InvalidRule(f"{self.name} takes no further actions")


@dataclass
class Rule:
    match: Match
    table: str = ""
    pattern: str | None = None
    params: list[Param] = field(default_factory=list)
    transient: str | None = None
    alias: str = "t"
    transient_template: str | None = None
    criteria: str | None = None
    template: str | None = None
    autodetect: bool = False
    unique: list[str] = field(default_factory=list)
    order: list[str] = field(default_factory=list)
    transform: dict[str, str] = field(default_factory=dict)
    sides: list[SideInput] = field(default_factory=list)
    split: list[tuple[str, str]] = field(default_factory=list)
    cluster: list[str] = field(default_factory=list)
    time_column: str | None = None
    append: bool = True
    method: str = "COPY"
    allow_field_addition: bool = False
    expiry_seconds: int | None = None
    options: LoadOptions = field(default_factory=LoadOptions)
    window_seconds: int | None = None
    multi_path: bool = False
    roll_over: bool = False
    pattern_hash: bool = False
    on_success: list[Action] = field(default_factory=list)
    on_failure: list[Action] = field(default_factory=list)
    max_reload: int = MAX_RELOAD
    disabled: bool = False
    name: str = ""
    allow_field_relaxation: bool = False

    @property
    def transforms(self) -> bool:
        return bool(self.sides or self.transform or self.split or self.unique)

    def destination(self, source: SourceFile) -> str:
        return expand(self.table, source, self.pattern, self.params)

    def destinations(self, url: Column, modified: Column) -> Column:
        """The destination of every file of a table of files."""
        return expanded(self.table, url, modified, self.pattern, self.params)

    def validate(self) -> None:
        if not self.table and not ((self.template or self.autodetect) and self.transient):
            raise InvalidRule("a table is needed")
        if self.transforms and not self.transient:
            raise InvalidRule("a transformation needs a transient dataset")
        if self.autodetect and self.transforms:
            raise InvalidRule("autodetect and a transformation exclude each other")
        if any(not when or not then for when, then in self.split):
            raise InvalidRule("a split needs both When and Then")
        for s in self.sides:
            if not (s.table or s.query) or not s.alias or not s.on:
                raise InvalidRule("a side input needs Table or From, Alias and On")
            if s.table and "." not in s.table:
                raise InvalidRule(f"side input {s.table} needs a dataset")
            if "$" not in s.on and not (f"{s.alias}." in s.on and f"{self.alias}." in s.on):
                raise InvalidRule(f"On must mention {self.alias} and {s.alias}")
        if self.method not in ("COPY", "QUERY", "DML"):
            raise InvalidRule(f"unknown copy method {self.method}")
        if clash := {c.lower() for c in self.transform} & {u.lower() for u in self.unique}:
            raise InvalidRule(f"unique columns with a transform: {sorted(clash)}")
        if self.window_seconds is not None and self.window_seconds < WINDOW_LEAST:
            raise InvalidRule(f"windows last {WINDOW_LEAST} seconds or more")
        groups_of(self.pattern, "")


def _lower(raw: dict) -> dict:
    return {str(k).lower(): v for k, v in raw.items()}


def parse(raw: dict, name: str = "") -> Rule:
    """A rule from its YAML or JSON form, with defaults, validated. Its keys are fixed names, in any case."""
    top = _lower(raw)
    when, dest, batch = (_lower(top.get(k) or {}) for k in ("when", "dest", "batch"))
    transient, schema = _lower(dest.get("transient") or {}), _lower(dest.get("schema") or {})
    split, window = _lower(schema.get("split") or {}), _lower(batch.get("window") or {})
    sides = [_lower(s) for s in dest.get("sideinputs") or []]
    disposition = dest.get("writedisposition") or ""
    override = dest.get("override")
    method = (dest.get("copymethod") or transient.get("copymethod") or "COPY").upper()
    options = LoadOptions(
        dest.get("sourceformat"),
        int(dest.get("skipleadingrows") or 0),
        int(dest.get("maxbadrecords") or 0),
        bool(dest.get("allowjaggedrows")),
        bool(dest.get("ignoreunknownvalues")),
        bool(schema.get("autodetect")),
        {k: str(dest[k.lower()]) for k in ("FieldDelimiter", "Quote", "AllowQuotedNewlines", "Encoding", "NullMarker") if dest.get(k.lower()) is not None},
    )
    rule = Rule(
        Match(when.get("prefix") or "", when.get("suffix") or "", when.get("filter") or dest.get("pattern"), when.get("exclusion")),
        dest.get("table") or "",
        dest.get("pattern"),
        [Param(_lower(p)["name"], str(_lower(p)["expression"])) for p in dest.get("parameters") or []],
        transient.get("dataset") or dest.get("transientdataset"),
        transient.get("alias") or "t",
        transient.get("template"),
        transient.get("criteria"),
        schema.get("template"),
        bool(schema.get("autodetect")),
        list(dest.get("uniquecolumns") or []),
        list(dest.get("ordercolumns") or []),
        dict(dest.get("transform") or {}),
        [SideInput(s.get("alias") or "", s.get("on") or s.get("true") or "", s.get("table"), s.get("from"), bool(s.get("inner"))) for s in sides],
        [(_lower(m).get("when") or "", _lower(m).get("then") or "") for m in split.get("mapping") or []],
        list(split.get("clustercolumns") or []),
        split.get("timecolumn"),
        not override if override is not None else disposition in ("", "WRITE_APPEND"),
        method,
        "ALLOW_FIELD_ADDITION" in (dest.get("schemaupdateoptions") or []) or bool(dest.get("allowfieldaddition")),
        int(dest["expiry"]) if dest.get("expiry") else None,
        options,
        int(window.get("durationinsec") or WINDOW_SECONDS) if batch else None,
        bool(batch.get("multipath")),
        bool(batch.get("rollover")),
        bool(batch.get("usepatternhash") or dest.get("usepatternhash")),
        [Action.load(a) for a in top.get("onsuccess") or []],
        [Action.load(a) for a in top.get("onfailure") or []],
        int(top.get("maxreload") or MAX_RELOAD),
        bool(top.get("disabled")),
        name,
        "ALLOW_FIELD_RELAXATION" in (dest.get("schemaupdateoptions") or []) or bool(dest.get("allowfieldrelaxation")),
    )
    if rule.transforms and rule.method == "COPY":
        rule.method = "QUERY"
    if split and not rule.split:
        raise InvalidRule("a split needs mappings")
    rule.validate()
    return rule


def load_rules(path: str) -> list[Rule]:
    """The rules of a YAML or JSON file, which holds one rule or a list of them."""
    text = read_text(path)
    raw = json.loads(text) if path.endswith(".json") else yaml.safe_load(text)
    return [parse(r, path) for r in (raw if isinstance(raw, list) else [raw])]


class SeveralRules(ValueError):
    pass


def rule_for(rules: list[Rule], path: str) -> Rule | None:
    """The one enabled rule that takes a path; several are an error."""
    import re

    def takes(m: Match) -> bool:
        return (
            path.startswith(m.prefix)
            and path.endswith(m.suffix)
            and (not m.filter or re.search(m.filter, path) is not None)
            and (not m.exclusion or re.search(m.exclusion, path) is None)
        )

    found = [r for r in rules if not r.disabled and takes(r.match)]
    if len(found) > 1:
        raise SeveralRules(f"{path}: {[r.name for r in found]}")
    return found[0] if found else None


def rules_for_table(rules: list[Rule], table: str) -> list[Rule]:
    """Rules that write to a table, by part of its name."""
    return [r for r in rules if table in re_plain(r.table) or any(table in re_plain(then) for _, then in r.split)]


def re_plain(name: str) -> str:
    return name.split(":")[-1]


def assign_rules(files: DataFrame, rules: list[Rule]) -> DataFrame:
    """files with the name of the one enabled rule that takes each, or null; several are an error."""
    names = F.array_compact(F.array(*[F.when(r.match.condition(F.col("url")), F.lit(r.name)) for r in rules if not r.disabled]))
    several = F.raise_error(F.concat(F.col("url"), F.lit(": several rules: "), F.array_join(names, ", "))).cast("string")
    return files.withColumn("rule", F.when(F.size(names) > 1, several).otherwise(F.get(names, F.lit(0))))
