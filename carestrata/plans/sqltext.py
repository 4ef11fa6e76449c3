"""SQL text files: named values become bound parameters, object names quoted identifiers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from carestrata.plans.tables import create_or_replace_as

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*\Z")
_MARK = re.compile(r"'\{(\w+)\}'|\{\{\s*(\w+)\s*\}\}|\{(\w+)\}")
_PIECE = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'\"`;/-]+|.", re.DOTALL)
_LEADING = re.compile(r"\A(?:\s+|--[^\n]*(?:\n|\Z)|/\*.*?\*/)+", re.DOTALL)
_REPLACE_AS = re.compile(r"\s*CREATE\s+OR\s+REPLACE\s+TABLE\s+(\S+)\s+AS\s+(.*)\Z", re.IGNORECASE | re.DOTALL)


def bind(text: str, objects: dict[str, str], values: dict[str, object]) -> tuple[str, dict[str, object]]:
    """`{name}`, `'{name}'` and `{{name}}` marks: a known object name is written quoted, a value is bound."""
    used: dict[str, object] = {}

    def fill(match: re.Match) -> str:
        name = next(g for g in match.groups() if g)
        if name in objects:
            if not _NAME.match(objects[name]):
                raise ValueError(f"not an object name: {objects[name]!r}")
            return ".".join(f"`{part}`" for part in objects[name].split("."))
        if name not in values:
            raise KeyError(f"template asks for {name!r}")
        used[name] = values[name]
        return f":{name}"

    return _MARK.sub(fill, text), used


def statements(text: str) -> list[str]:
    """Split at semicolons outside quotes and comments; comment-only pieces are dropped."""
    done, now, says = [], [], False
    for piece in _PIECE.findall(text):
        if piece == ";":
            if says:
                done.append("".join(now).strip())
            now, says = [], False
        else:
            now.append(piece)
            says = says or not (piece.isspace() or piece.startswith(("--", "/*")))
    if says:
        done.append("".join(now).strip())
    return done


def run_sql(
    spark: SparkSession, text: str, objects: dict[str, str] | None = None, values: dict[str, object] | None = None
) -> DataFrame | None:
    """Run the statements in turn; returns the last one's rows.

    `CREATE OR REPLACE TABLE t AS query`, which session-catalog tables do not take, replaces `t` by the query.
    """
    last = None
    bound, args = bind(text, objects or {}, values or {})
    for statement in statements(bound):
        own = {k: v for k, v in args.items() if re.search(rf":{k}\b", statement)}
        replace = _REPLACE_AS.match(_LEADING.sub("", statement))
        if replace:
            create_or_replace_as(spark.sql(replace[2], args=own), replace[1].replace("`", ""))
            last = spark.table(replace[1].replace("`", ""))
        else:
            last = spark.sql(statement, args=own)
    return last


def run_sql_file(spark: SparkSession, path: str, objects: dict[str, str], values: dict[str, object] | None = None):
    return run_sql(spark, spark.read.text(path, wholetext=True).first()[0], objects, values)
