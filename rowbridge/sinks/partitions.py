"""Loads into catalog tables: static partitions, file sizes, rewrites."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, quoted, session_setting, stage, staging

# Fixed value: a new file starts when the current one passes this size.
DEFAULT_FILE_SIZE = "128MB"
_UNITS = {"KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30}


def parse_size(text: str) -> int:
    """Bytes of ``8MB``, ``1GB``, ``64KB`` or a plain number."""
    match = re.fullmatch(r"\s*(\d+)\s*(KB|MB|GB)?\s*", text.upper())
    if match is None:
        raise ValueError(f"not a file size: {text}")
    return int(match.group(1)) * _UNITS.get(match.group(2), 1)


def parse_partition(text: str | Mapping[str, str]) -> dict[str, str]:
    """``dt='20250719',hour='01'`` as a dict in order."""
    if isinstance(text, Mapping):
        return dict(text)
    pairs = re.findall(r"\s*`?(\w+)`?\s*=\s*(?:'((?:[^']|'')*)'|([^,]*))\s*,?", text)
    if not pairs:
        raise ValueError(f"not a partition: {text}")
    return {name: (text_value.replace("''", "'") or bare.strip()) for name, text_value, bare in pairs}


def rows_per_file(df: DataFrame, max_file_size: str = DEFAULT_FILE_SIZE) -> int:
    """Rows that fit a file of the given size, by the measured mean row width in text form.

    One narrow aggregate over the rows; columnar files come out smaller.
    """
    width = F.lit(len(df.columns))
    for name in df.columns:
        kind, cell = df.schema[name].dataType, column(name)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(cell))
        else:
            text = cell if isinstance(kind, T.BinaryType) else cell.cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0))
    mean = df.agg(F.avg(width)).head()[0]
    return max(1, int(parse_size(max_file_size) / mean)) if mean else 1


def _ddl(df: DataFrame, partition: Mapping[str, str]) -> str:
    fields = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join(fields + [f"{quoted(k)} string" for k in partition])


def load_partition(
    df: DataFrame,
    table: str,
    partition: str | Mapping[str, str] | None = None,
    mode: str = "insert",
    file_type: str = "orc",
    compression: str = "NONE",
    max_file_size: str | None = None,
    location: str | None = None,
    sep: str = ",",
) -> None:
    """Load rows into a static partition, appending or replacing only that partition.

    A missing table is created with the rows' types, the partition columns as
    text; text files become CSV tables with ``sep``. ``max_file_size`` bounds the
    rows per file by the measured row width.
    """
    if mode not in ("insert", "overwrite"):
        raise ValueError(f"a partition load inserts or overwrites, not {mode}")
    spark = df.sparkSession
    keys = parse_partition(partition) if partition else {}
    if not spark.catalog.tableExists(table):
        clauses = f" PARTITIONED BY ({', '.join(quoted(k) for k in keys)})" if keys else ""
        place = f" LOCATION '{location}'" if location else ""
        text = file_type in ("csv", "txt", "text")
        options = f", sep '{_literal(sep)}'" if text else ""
        spark.sql(
            f"CREATE TABLE {table} ({_ddl(df, keys)}) USING {'csv' if text else file_type}"
            f" OPTIONS (compression '{compression.lower()}'{options}){clauses}{place}"
        )
    columns = [c for c in spark.table(table).columns if c not in keys]
    rows = df.select(*[column(c) for c in columns])
    verb = "OVERWRITE" if mode == "overwrite" else "INTO"
    spec = ", ".join(f"{quoted(k)} = '{_literal(v)}'" for k, v in keys.items())
    target = f"{table} PARTITION ({spec})" if keys else table
    limit = rows_per_file(rows, max_file_size) if max_file_size else 0
    with session_setting(spark, "spark.sql.files.maxRecordsPerFile", limit):
        spark.sql(f"INSERT {verb} {target} SELECT * FROM {{rows}}", rows=rows)


def _literal(value: str) -> str:
    """Text inside a SQL literal that also passes ``{name}`` parameters."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return escaped.replace("{", "{{").replace("}", "}}")


def roll_files_by_size(
    df: DataFrame,
    path: str,
    max_file_size: str = DEFAULT_FILE_SIZE,
    file_type: str = "orc",
    compression: str = "none",
    mode: str = "overwrite",
) -> int:
    """Write files of about the given size; returns the rows allowed per file."""
    limit = rows_per_file(df, max_file_size)
    writer = df.write.mode(mode).option("maxRecordsPerFile", limit)
    writer.option("compression", compression.lower()).format(file_type).save(path)
    return limit


def rewrite_table(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace a table's rows by a result computed from it.

    The result is staged first: a table is never overwritten while it is read.
    Partitions left without rows disappear whatever the session's overwrite mode.
    """
    static = session_setting(spark, "spark.sql.sources.partitionOverwriteMode", "static")
    with staging(spark), static:
        staged = stage(rows, "rewrite").select(*[column(c) for c in spark.table(table).columns])
        staged.write.insertInto(table, overwrite=True)


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is not true; unknown keeps the row."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def update_where(df: DataFrame, condition: str, assignments: Mapping[str, str]) -> DataFrame:
    """Set columns to SQL expressions over the old row where the condition is true."""
    hit = F.expr(condition)
    return df.select(
        *[
            F.when(hit, F.expr(assignments[f.name]).cast(f.dataType)).otherwise(column(f.name)).alias(f.name)
            if f.name in assignments
            else column(f.name)
            for f in df.schema.fields
        ]
    )
