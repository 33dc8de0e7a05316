"""JDBC sinks: rows are staged by Spark, conflicts are resolved by the database."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rowbridge.operators.merges import one_per_key

# The write modes each kind of target knows.
WRITE_MODES = {
    "mysql": ("insert", "replace", "update", "ignore"),
    "postgresql": ("insert", "update", "ignore"),
    "odps": ("insert",),
    "hive": ("insert", "overwrite"),
    "hbase": ("insert",),
    "txtfile": ("insert",),
}


def check_write_mode(kind: str, mode: str, keys: Sequence[str] = ()) -> str:
    mode = (mode or "insert").lower()
    allowed = WRITE_MODES[kind.lower()]
    if mode not in allowed:
        raise ValueError(f"{kind} does not support the write mode {mode}")
    if kind.lower() == "postgresql" and mode in ("update", "ignore") and not keys:
        raise ValueError(f"{mode} needs a primary key")
    return mode


def merge_statement(
    kind: str, table: str, staging: str, columns: Sequence[str], mode: str, keys: Sequence[str] = ()
) -> str:
    """One statement moving the staged rows into the table under the write mode."""
    names = ", ".join(columns)
    select = f"select {names} from {staging}"
    into = f"into {table} ({names}) {select}"
    kind = kind.lower()
    check_write_mode(kind, mode, keys)
    if mode == "insert":
        return f"insert {into}"
    if kind == "mysql":
        if mode == "replace":
            return f"replace {into}"
        if mode == "ignore":
            return f"insert ignore {into}"
        assignments = ", ".join(f"{c} = values({c})" for c in columns)
        return f"insert {into} on duplicate key update {assignments}"
    conflict = f"on conflict ({', '.join(keys)})"
    if mode == "ignore":
        return f"insert {into} {conflict} do nothing"
    assignments = ", ".join(f"{c} = excluded.{c}" for c in columns if c not in keys)
    if not assignments:
        return f"insert {into} {conflict} do nothing"
    return f"insert {into} {conflict} do update set {assignments}"


def run_statements(spark: SparkSession, options: dict[str, str], statements: Sequence[str]) -> None:
    """Run statements on the database from the driver, in order."""
    wanted = [s for s in statements if s and s.strip()]
    if not wanted:
        return
    jvm = spark._jvm
    jvm.java.lang.Class.forName(options["driver"])
    properties = jvm.java.util.Properties()
    for key in ("user", "password", "allowMultiQueries"):
        if key in options:
            properties.setProperty(key, options[key])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        statement = connection.createStatement()
        if options.get("sessionInitStatement"):
            statement.execute(options["sessionInitStatement"])
        for text in wanted:
            statement.execute(text)
    finally:
        connection.close()


def write_jdbc(
    df: DataFrame,
    options: dict[str, str],
    kind: str,
    table: str,
    mode: str = "insert",
    keys: Sequence[str] = (),
) -> None:
    """Insert directly; other modes load a staging table and merge it once.

    Retried tasks may write rows twice into a table without a key, so a plain
    insert also goes through the staging table when keys are given.
    """
    mode = check_write_mode(kind, mode, keys)
    spark = df.sparkSession
    if mode == "insert" and not keys:
        df.write.format("jdbc").options(**options, dbtable=table).mode("append").save()
        return
    if keys and kind.lower() == "postgresql" and mode == "update":
        # One statement may not update a row twice.
        df = one_per_key(df, keys, None, last=True)
    staging = f"{table}_stage_{uuid.uuid4().hex[:8]}"
    run_statements(spark, options, [f"create table {staging} as select * from {table} where 1 = 0"])
    try:
        df.write.format("jdbc").options(**options, dbtable=staging).mode("append").save()
        run_statements(
            spark, options, [merge_statement(kind, table, staging, df.columns, mode, keys)]
        )
    finally:
        run_statements(spark, options, [f"drop table {staging}"])
