"""Run registered queries against DuckDB: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowbridge")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if value != value else repr(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(listed, key=repr)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(spark, con, sf_dir, name, query, sql, inspect=None) -> str | None:
    df = query(spark, sf_dir)
    if inspect is not None:
        inspect(df._jdf.queryExecution().executedPlan().toString())
    got_columns, got = normal(df.columns, df.collect())
    if sql is None:
        return None
    result = con.execute(sql)
    want_columns, want = normal([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), oracle(sf_dir)
    sqls = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = differences(spark, con, sf_dir, name, query, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - started:6.2f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
