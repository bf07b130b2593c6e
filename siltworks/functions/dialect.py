"""The few spellings of rule SQL that Spark reads differently.

Rules come from a warehouse dialect. Only these differ; everything else goes to Spark's own
parser as it is.
"""

from __future__ import annotations

import re

#: Fixed names of the source dialect and Spark's.
TYPES = {
    "INT64": "BIGINT", "INTEGER": "BIGINT", "FLOAT64": "DOUBLE", "FLOAT": "DOUBLE", "BOOL": "BOOLEAN",
    "BOOLEAN": "BOOLEAN", "STRING": "STRING", "TIMESTAMP": "TIMESTAMP", "DATE": "DATE",
}

_QUOTED = r"'(?:[^'\\]|\\.)*'"
#: What no rewriting may touch: texts and comments. A backtick name is a part of its own.
_SOLID = re.compile(rf"""({_QUOTED}|"(?:[^"\\]|\\.)*"|--[^\n]*|/\*.*?\*/|`[^`]*`)""", re.S)
_SPLIT = re.compile(r"\bSPLIT\s*\(([^()]|\([^()]*\))*,\s*$", re.I)
_UNNEST = r"(,|\bFROM\b|\bJOIN\b)\s*UNNEST\s*\(([^()]*(?:\([^()]*\)[^()]*)*)\)\s+(?:AS\s+)?"
#: What may follow an offset without a name.
_CLAUSE = r"(?:ON|WHERE|JOIN|GROUP|HAVING|ORDER|LIMIT|LEFT|RIGHT|FULL|CROSS|INNER|UNION|QUALIFY)\b"
_AFTER = r"\b(FROM|JOIN|INTO|UPDATE|TABLE)(\s+)"


def to_spark(sql: str) -> str:
    """Rewrite typed nulls, literal SPLIT delimiters, dotted backtick names, [p:d.t] tables and UNNEST.

    `TYPE(NULL)` becomes a cast; SPLIT's delimiter, a plain text there, is quoted against being
    read as a pattern; `p.d.t` in one pair of backticks is quoted part by part, and a project
    in front is dropped, as one session has one catalog. A text may stand in double quotes there,
    also as a delimiter. Brackets name a table only after FROM,
    JOIN, INTO, UPDATE or TABLE; elsewhere they are an index. UNNEST in FROM is a lateral
    explode. Texts and comments stay as they are.
    """
    out, held = "", []
    # what is solid is held apart, so that a pattern may reach over it
    for k, part in enumerate(_SOLID.split(sql)):
        if k % 2 == 0:
            out += part
            continue
        if part[0] == "`":
            part = re.sub(r"^`(?:[\w-]+[:.])?([\w-]+)\.([\w-]+)`$", lambda m: f"`{m[1]}`.`{m[2]}`", part)
        elif part[0] in "'\"" and len(part) > 2 and "\\" not in part and _SPLIT.search(out):
            part = rf"{part[0]}\\Q{part[1:-1]}\\E{part[0]}"
        out += f"\0{len(held)}\0"
        held.append(part)
    names = "|".join(TYPES)
    out = re.sub(rf"\b({names})\s*\(\s*NULL\s*\)", lambda m: f"CAST(NULL AS {TYPES[m[1].upper()]})", out, flags=re.I)
    out = re.sub(_AFTER + r"\[(?:[\w-]+:)?([\w-]+\.[\w$-]+)\]", lambda m: f"{m[1]}{m[2]}{m[3]}", out, flags=re.I)
    out = re.sub(
        rf"{_UNNEST}(?!ON\b|WHERE\b|WITH\b)(\w+)\s+WITH\s+OFFSET(?:\s+(?:AS\s+)?(?!{_CLAUSE})(\w+))?",
        lambda m: f"{m[1]} LATERAL posexplode({m[2]}) AS {m[3]}_({m[4] or 'offset'}, {m[3]})",
        out,
        flags=re.I,
    )
    out = re.sub(rf"{_UNNEST}(?!ON\b|WHERE\b|WITH\b)(\w+)", lambda m: f"{m[1]} LATERAL explode({m[2]}) AS {m[3]}_({m[3]})", out, flags=re.I)
    return re.sub("\0(\\d+)\0", lambda m: held[int(m[1])], out)


def is_dml(sql: str) -> bool:
    """Whether a statement changes a table itself, by its first word that isn't a comment."""
    plain = re.sub(rf"--[^\n]*|/\*.*?\*/|{_QUOTED}", " ", sql, flags=re.S).strip().lower()
    if plain.startswith("with"):
        depth, found = 0, "select"
        for word in re.findall(r"[()]|\w+", plain):
            depth += {"(": 1, ")": -1}.get(word, 0)
            if depth == 0 and word in ("select", "insert", "merge", "update", "delete"):
                found = word
                break
        return found != "select"
    return plain.split(None, 1)[0] in ("insert", "merge", "update", "delete") if plain else False
