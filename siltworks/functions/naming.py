"""Names derived from files: hashes, variables, table references and window names."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: 64-bit FNV offset basis and prime.
FNV_BASIS = 14695981039346656037
FNV_PRIME = 1099511628211


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def fnv1(text: str) -> int:
    """64-bit FNV-1 of the UTF-8 bytes as a signed number, made positive."""
    h = FNV_BASIS
    for b in text.encode():
        h = (h * FNV_PRIME & (1 << 64) - 1) ^ b
    return abs(_signed(h))


def fnv1a(text: str) -> int:
    """64-bit FNV-1a of the UTF-8 bytes as a signed number, made positive."""
    h = FNV_BASIS
    for b in text.encode():
        h = (h ^ b) * FNV_PRIME & (1 << 64) - 1
    return abs(_signed(h))


def fnv1_many(texts: pd.Series) -> pd.Series:
    """fnv1 of every text of a batch, null for null: one step for each byte position, all texts at once."""
    raw = [t.encode() for t in texts.dropna()]
    order = np.argsort([-len(r) for r in raw], kind="stable")
    sizes, flat = np.array([len(r) for r in raw], np.int64), np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    h = np.full(len(raw), FNV_BASIS, np.uint64)
    live = len(raw)
    for k in range(int(sizes.max(initial=0))):
        while live and sizes[order[live - 1]] <= k:
            live -= 1
        rows = order[:live]
        h[rows] = h[rows] * np.uint64(FNV_PRIME) ^ flat[starts[rows] + k]
    out = pd.Series(pd.NA, texts.index, "Int64")
    out[texts.notna()] = np.abs(h.view(np.int64))
    return out


@dataclass(frozen=True)
class TableRef:
    dataset: str
    table: str
    project: str | None = None

    @classmethod
    def parse(cls, text: str) -> TableRef:
        """[project:]dataset.table or project.dataset.table; the table may name a $partition."""
        text = text.strip("`")
        project, sep, rest = text.partition(":")
        parts = (rest if sep else text).split(".")
        if not sep and len(parts) == 3:
            project, parts = parts[0], parts[1:]
            sep = "."
        if len(parts) != 2 or not all(parts):
            raise ValueError(f"not a table reference: {text!r}")
        return cls(parts[0], parts[1], project if sep else None)

    @property
    def partition(self) -> str | None:
        return self.table.partition("$")[2] or None

    @property
    def name(self) -> str:
        """The name in the session catalog, without project and partition."""
        return f"{self.dataset}.{self.table.partition('$')[0]}"


@dataclass(frozen=True)
class SourceFile:
    url: str
    modified: datetime

    @property
    def path(self) -> str:
        return re.sub(r"^[a-zA-Z][\w+.-]*:/*(?=/)|^(gs|s3|s3a)://[^/]+", "", self.url)


@dataclass(frozen=True)
class Param:
    name: str
    expression: str


def _texts(expression: str) -> str:
    """Evaluate $ToLower(x), $ToUpper(x) and $Replace(x, a, b), the innermost first."""
    calls = {
        "ToLower": lambda x: x.lower(),
        "ToUpper": lambda x: x.upper(),
        "Replace": lambda x, a, b: x.replace(a.strip().strip("'"), b.strip().strip("'")),
    }
    while found := re.search(r"\$(ToLower|ToUpper|Replace)\(([^()$]*)\)", expression):
        arguments = found[2].split(",") if found[1] == "Replace" else [found[2]]
        expression = expression[: found.start()] + calls[found[1]](*arguments) + expression[found.end() :]
    return expression


def groups_of(pattern: str | None, path: str) -> dict[int, str]:
    """Groups 1, 2, ... of a pattern in a path; a pattern that isn't valid raises re.error."""
    if not pattern:
        return {}
    found = re.search(pattern, path)
    return {k + 1: g or "" for k, g in enumerate(found.groups())} if found else {}


def _numbered(text: str, groups: dict[int, str]) -> str:
    return re.sub(r"\$(\d+)", lambda m: groups.get(int(m[1]), m[0]), text)


def parameters(params: list[Param], pattern: str | None, path: str) -> dict[str, str]:
    """Named parameters: pattern groups first, then text functions."""
    groups = groups_of(pattern, path)
    return {p.name: _texts(_numbered(p.expression, groups)) for p in params}


def expand(text: str, source: SourceFile, pattern: str | None = None, params: list[Param] | None = None, hour24: bool = False) -> str:
    """Expand $Mod(n), $Date, $Hour, $1.. and named parameters, in one pass.

    $Mod is the hash of the source's URL modulo n. $Date and $Hour are of its modification
    time in UTC; $Hour is on a 12-hour clock unless hour24 is set.
    """
    at, groups = source.modified.astimezone(timezone.utc), groups_of(pattern, source.path)
    named = parameters(params or [], pattern, source.path)

    def one(m: re.Match) -> str:
        if m[1]:
            return str(fnv1(source.url) % int(m[1]))
        if m[2] or m[3]:
            return at.strftime("%Y%m%d" if m[2] else "%H" if hour24 else "%I")
        return groups.get(int(m[4]), m[0]) if m[4] else named[m[5] or m[6]]

    return _tokens(named).sub(one, text)


def _tokens(names) -> re.Pattern:
    """What names are expanded from: $Mod(n), $Date, $Hour, $1.., ${Name} and $Name, the longest name first."""
    known = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True)) or r"(?!)"
    return re.compile(rf"\$Mod\((\d+)\)|(\$Date)|(\$Hour)|\$(\d+)|\$\{{({known})\}}|\$({known})\b")


_CALL = re.compile(r"\$(ToLower|ToUpper|Replace)\(|\$(\d+)")


def text_column(expression: str, group) -> Column:
    """What `parameters` makes of one expression, as a column; group(k) is the column of a pattern's group."""

    def parts(at: int, inner: bool) -> tuple[list[list[Column]], int]:
        # arguments of a call, or the whole text as one; commas and brackets count within calls only
        args, text = [[]], ""

        def flush():
            nonlocal text
            if text:
                args[-1].append(F.lit(text))
                text = ""

        while at < len(expression):
            if found := _CALL.match(expression, at):
                flush()
                at = found.end()
                if found[2]:
                    args[-1].append(group(int(found[2])))
                    continue
                own, at = parts(at, True)
                x = joined(own[0])
                if found[1] == "Replace":
                    a, b = (F.regexp_replace(F.trim(joined(y)), "^'+|'+$", "") for y in own[1:3])
                    args[-1].append(F.replace(x, a, b))
                else:
                    args[-1].append(F.lower(x) if found[1] == "ToLower" else F.upper(x))
                continue
            c, at = expression[at], at + 1
            if inner and c == ")":
                flush()
                return args, at
            if inner and c == ",":
                flush()
                args.append([])
            else:
                text += c
        flush()
        return args, at

    joined = lambda columns: F.concat(*columns) if columns else F.lit("")
    return joined(parts(0, False)[0][0])


def expanded(text: str, url: Column, modified: Column, pattern: str | None = None, params: list[Param] | None = None, hour24: bool = False) -> Column:
    """`expand` for every file at once, as a column: only $Mod's hash leaves the JVM."""
    path = F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*:/*(?=/)|^(gs|s3|s3a)://[^/]+", "")
    n_groups = re.compile(pattern).groups if pattern else 0

    def group(k: int) -> Column:
        if not 1 <= k <= n_groups:
            return F.lit(f"${k}")
        return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, k)).otherwise(F.lit(f"${k}"))

    def value(expression: str) -> Column:
        # without its groups a text function has nothing to work on and stays as it is written
        if not re.search(r"\$\d", expression):
            return text_column(expression, group)
        return F.when(path.rlike(pattern), text_column(expression, group)).otherwise(F.lit(expression)) if pattern else F.lit(expression)

    named = {p.name: value(p.expression) for p in params or []}
    token = _tokens(named)
    at_utc = F.to_utc_timestamp(modified.cast("timestamp"), F.current_timezone())
    out, at = [], 0
    for m in token.finditer(text):
        out.append(F.lit(text[at : m.start()]))
        at = m.end()
        if m[1]:
            out.append(_shard(url, int(m[1])).cast("string"))
        elif m[2] or m[3]:
            out.append(F.date_format(at_utc, "yyyyMMdd" if m[2] else "HH" if hour24 else "hh"))
        else:
            out.append(group(int(m[4])) if m[4] else named[m[5] or m[6]])
    return F.concat(*out, F.lit(text[at:]))


def _shard(url: Column, n: int) -> Column:
    @F.pandas_udf("long")
    def shard(urls: pd.Series) -> pd.Series:
        return fnv1_many(urls) % n

    return shard(url)


def table_name(reference: Column) -> Column:
    """The session catalog's name of a table reference, without project and partition."""
    plain = F.regexp_replace(F.regexp_replace(reference, "^`|`$", ""), r"^[^:]*:|^[^.]*\.(?=[^.]*\.)", "")
    return F.regexp_replace(plain, r"\$.*$", "")


@dataclass
class Variables:
    """Values that rule texts refer to as $Name or ${Name}; unknown names stay as they are."""

    values: dict[str, object] = field(default_factory=dict)

    def _found(self, name: str) -> tuple[object, str] | None:
        """The value of the longest known name that a text starts with, and what follows it."""
        known = max((n for n in self.values if name.startswith(n)), key=len, default=None)
        if known is None:
            return None
        value, rest = self.values[known], name[len(known) :]
        while isinstance(value, dict) and (part := re.match(r"\.(\w+)", rest)) and part[1] in value:
            value, rest = value[part[1]], rest[part.end() :]
        return value, rest

    def put(self, text: str) -> str:
        def one(m: re.Match) -> str:
            found = self._found(m[1] or m[2])
            if found is None or (m[1] and found[1]):
                return m[0]
            value = found[0]
            return (",".join(map(str, value)) if isinstance(value, list | tuple) else str(value)) + found[1]

        return re.sub(r"\$\{([\w.]+)\}|\$([A-Za-z]\w*(?:\.\w+)*)", one, text)

    def put_all(self, value):
        """Expand every text in nested dicts and lists; "$LoadURIs" alone stays a list."""
        if isinstance(value, str):
            name = value.strip("${}")
            own = self.values.get(name)
            return own if value in (f"${name}", f"${{{name}}}") and isinstance(own, list) else self.put(value)
        if isinstance(value, dict):
            return {k: self.put_all(v) for k, v in value.items()}
        if isinstance(value, list):
            return [self.put_all(v) for v in value]
        return value


def window_end(epoch: int, seconds: int) -> int:
    """End of the tumbling window that holds a time; a time on a boundary begins the next one."""
    return epoch - epoch % seconds + seconds


def end_of_window_file(url: str) -> int:
    """Unix time in a name such as dataset.table_1582068825.win."""
    found = re.search(r"_(\d+)\.\w{3}$", url)
    if not found:
        raise ValueError(f"not a window file: {url!r}")
    return int(found[1])


def activity_id(table: str, event_id: str, step: int, action: str, mode: str) -> str:
    """Name of one step of a run: table/event_step_action--mode."""
    return f"{table}/{event_id}_{step % 99999:05d}_{action}--{mode}"


def parse_activity_id(text: str) -> dict:
    """Table, event, step, action and mode of a step's name, with -- or / between its parts."""
    parts = text.replace(".json", "", 1).replace("--", "/").split("/")
    mode = "dispatch" if parts[-1].endswith("dispatch") else "tail"
    out = {"table": "", "event_id": "", "step": 0, "action": "nop", "mode": mode}
    if len(parts) < 2:
        return out
    fields = parts[-2].split("_")
    out |= {"table": "--".join(parts[:-2]), "event_id": fields[0]}
    if len(fields) > 2:
        out |= {"step": int(fields[1]), "action": fields[2]}
    return out


def window_file_end(url: Column) -> Column:
    """end_of_window_file of a column; null where it isn't a window file."""
    return F.nullif(F.regexp_extract(url, r"_(\d+)\.\w{3}$", 1), F.lit("")).cast("long")


def activity_ids(table: Column, event_id: Column, step: Column, action: Column, mode: Column) -> Column:
    """activity_id of columns."""
    number = F.lpad((step % 99999).cast("string"), 5, "0")
    return F.concat(table, F.lit("/"), event_id, F.lit("_"), number, F.lit("_"), action, F.lit("--"), mode)


def activity_parts(text: Column) -> Column:
    """parse_activity_id of a column, as a struct."""
    parts = F.split(F.replace(F.regexp_replace(text, r"\.json", ""), F.lit("--"), F.lit("/")), "/")
    size, part = F.size(parts), lambda k: F.get(parts, F.size(parts) - k)
    fields = F.split(part(2), "_")
    whole, long_ = size >= 2, (size >= 2) & (F.size(fields) > 2)
    return F.struct(
        F.when(whole, F.array_join(F.slice(parts, 1, F.greatest(F.lit(0), size - 2)), "--")).otherwise("").alias("table"),
        F.when(whole, F.get(fields, F.lit(0))).otherwise("").alias("event_id"),
        F.when(long_, F.get(fields, F.lit(1)).cast("int")).otherwise(0).alias("step"),
        F.when(long_, F.get(fields, F.lit(2))).otherwise("nop").alias("action"),
        F.when(part(1).endswith("dispatch"), "dispatch").otherwise("tail").alias("mode"),
    )


def history_name(path: Column) -> Column:
    """Name of the file that notes what of a source path has been taken: MD5 in base 64, unpadded."""
    return F.concat(F.replace(F.base64(F.unhex(F.md5(path))), F.lit("="), F.lit("")), F.lit(".json"))
