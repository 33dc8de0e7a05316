"""SQL scripts: statements in order, the last result kept."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession

from rowbridge.sinks.partitions import delete_where, rewrite_table, update_where
from rowbridge.sinks.touched import delete_from, file_backed, update_table

_PIECES = re.compile(
    r"""--[^\n]*                    # line comment
      | /\*(?!\+).*?\*/             # block comment, hints stay
      | '(?:[^'\\]|\\.|'')*'
      | "(?:[^"\\]|\\.|"")*"
      | `[^`]*`
      | ;
      | .""",
    re.VERBOSE | re.DOTALL,
)

_DELETE = re.compile(r"^delete\s+from\s+([\w.`]+)(?:\s+where\s+(.+))?$", re.IGNORECASE | re.DOTALL)
_UPDATE = re.compile(r"^update\s+([\w.`]+)\s+set\s+(.+)$", re.IGNORECASE | re.DOTALL)
_OPENING, _CLOSING = "([", ")]"

_RESULT = re.compile(r"^\(*\s*(select|with|values|table|from|show|describe|desc|explain)\b", re.IGNORECASE)


def split_statements(script: str) -> list[str]:
    """Statements of a script; ``;`` inside quotes and comments does not count."""
    statements, current = [], []
    for piece in _PIECES.findall(script):
        if piece == ";":
            statements.append("".join(current))
            current = []
        elif piece.startswith("--") or piece.startswith("/*") and not piece.startswith("/*+"):
            current.append(" ")
        else:
            current.append(piece)
    statements.append("".join(current))
    return [s.strip() for s in statements if s.strip()]


def returns_rows(statement: str) -> bool:
    return bool(_RESULT.match(statement))


def parse_assignments(text: str) -> tuple[dict[str, str], str]:
    """Assignments and condition of ``a = 1, b = f(c, d) WHERE e``; text in quotes or brackets is not cut."""
    parts, depth, condition = [""], 0, None
    pieces = re.findall(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\w+|.", text, re.DOTALL)
    cases = 0
    for place, piece in enumerate(pieces):
        depth += (piece in _OPENING) - (piece in _CLOSING)
        cases += (piece.lower() == "case") - (piece.lower() == "end")
        if depth == 0 and cases == 0 and piece.lower() == "where":
            condition = "".join(pieces[place + 1 :])
            break
        if depth == 0 and cases == 0 and piece == ",":
            parts.append("")
        else:
            parts[-1] += piece
    found = {}
    for part in parts:
        name, equal, value = part.partition("=")
        if not equal or not value.strip():
            raise ValueError(f"not an assignment: {part.strip()}")
        found[name.strip().split(".")[-1].strip("`")] = value.strip()
    return found, (condition or "true").strip()


def execute(spark: SparkSession, statement: str) -> DataFrame:
    """Run one statement; DELETE and UPDATE also work on plain tables, by rewriting the files they touch."""
    delete, update = _DELETE.match(statement), _UPDATE.match(statement)
    try:
        return spark.sql(statement)
    except (AnalysisException, UnsupportedOperationException) as error:
        if not (delete or update) or "UNSUPPORTED" not in (error.getCondition() or ""):
            raise
    table = (delete or update).group(1)
    whole = not file_backed(spark, table)
    if delete:
        condition = delete.group(2) or "true"
        if whole:
            rewrite_table(spark, table, delete_where(spark.table(table), condition))
        else:
            delete_from(spark, table, condition)
        return spark.range(0)
    assignments, condition = parse_assignments(update.group(2))
    known = {c.lower(): c for c in spark.table(table).columns}
    unknown = [c for c in assignments if c.lower() not in known]
    if unknown:
        raise ValueError(f"columns missing in {table}: {unknown}")
    values = {known[c.lower()]: v for c, v in assignments.items()}
    if whole:
        rewrite_table(spark, table, update_where(spark.table(table), condition, values))
    else:
        update_table(spark, table, condition, values)
    return spark.range(0)


def run_script(spark: SparkSession, statements: str | Sequence[str]) -> DataFrame | None:
    """Run statements in order; the last one's rows, or None if it returns none.

    Commands run at once and the first error stops the script. Results of
    earlier queries are not wanted, so these are analysed but never executed.
    """
    listed = split_statements(statements) if isinstance(statements, str) else [
        s for s in statements if s and s.strip()
    ]
    if not listed:
        raise ValueError("the SQL script is empty")
    result = None
    for statement in listed:
        result = execute(spark, statement)
    return result if returns_rows(listed[-1]) else None
