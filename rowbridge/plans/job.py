"""JSON jobs: read, transform, write, reconcile, report.

Modes: 0 exports a table or query to files, 1 runs a SQL script and exports the
last result, 2 moves rows from a reader through transformers to a writer.
"""

from __future__ import annotations

import json
import re
import time
import traceback
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, stage
from rowbridge.functions.kinds import canonicalize, spark_type
from rowbridge.operators.cells import cell_columns, cells_to_rows, rows_to_cells
from rowbridge.operators.merges import merge_ignore, merge_insert, merge_replace, merge_update, rows_with_keys
from rowbridge.operators.numbering import row_chunks
from rowbridge.operators.report import CountCheck, RowCounter, written_rows
from rowbridge.operators.splits import rowkey_bounds
from rowbridge.operators.targets import bind_to_target
from rowbridge.operators.transforms import apply_chain
from rowbridge.plans.script import execute, run_script
from rowbridge.sinks.chunks import DEFAULT_CHUNK_ROWS, export_column_chunks, export_row_chunks
from rowbridge.sinks.columnar import export_json, export_orc, export_parquet
from rowbridge.sinks.delimited import export_csv, write_delimited
from rowbridge.sinks.jdbc import check_write_mode, run_statements, write_jdbc
from rowbridge.sinks.partitions import load_partition, parse_partition
from rowbridge.sinks.touched import merge_table
from rowbridge.sources.delimited import read_delimited, read_lines, separator
from rowbridge.sources.jdbc import jdbc_options, primary_key, read_jdbc
from rowbridge.sources.tables import declared_columns, extract_query, extract_table, read_catalog_table

EXPORT, SCRIPT, MOVE = 0, 1, 2
FILE_TYPES = ("csv", "txt", "json", "parquet", "orc")
JDBC_KINDS = ("mysql", "postgresql", "odps")
SUCCESS, FAILED = 0, 1
MERGES = {"ignore": merge_ignore, "update": merge_update, "replace": merge_replace}


def substitute(text: str, variables: Mapping[str, str] | None = None) -> str:
    """Replace ``${name}`` and ``$name``; unknown and blank variables stay."""
    known = variables or {}

    def value(match: re.Match) -> str:
        found = known.get(match.group(1))
        return found if found and found.strip() else match.group(0)

    return re.sub(r"\$\{?(\w+)\}?", value, text)


def load_job(path: str, variables: Mapping[str, str] | None = None) -> dict:
    return json.loads(substitute(Path(path).read_text(encoding="utf-8"), variables))


class Job:
    """One job against one session.

    ``tables`` maps names used in the job to DataFrames; they take the place of
    the database table or cell table of that name, also inside queries.
    """

    def __init__(
        self,
        spark: SparkSession,
        job: dict,
        tables: Mapping[str, DataFrame] | None = None,
        zone: str | None = None,
    ) -> None:
        self.spark = spark
        self.body = job["job"]
        self.tables = dict(tables or {})
        for name, rows in self.tables.items():
            if re.fullmatch(r"\w+", name):
                rows.createOrReplaceTempView(name)
        self.zone = zone
        self.content = self.body["content"][0]
        self.setting = self.body.get("setting") or {}
        self.channel = int((self.setting.get("speed") or {}).get("channel", 2))

    # ------------------------------------------------------------- reading

    def _side(self, side: str) -> tuple[str, dict]:
        block = self.content.get(side)
        if not block:
            raise ValueError(f"the job has no {side}")
        return block["name"], block.get("parameter") or {}

    def _options(self, kind: str, parameter: dict) -> dict[str, str]:
        connection = {**parameter, **(parameter.get("connection") or {})}
        return jdbc_options(kind, connection, parameter.get("session") or ())

    def _scan(self, name: str, parameter: dict, order_by: str | None = None) -> DataFrame:
        kind = name.lower()
        table, query = parameter.get("table"), (parameter.get("querySql") or "").strip() or None
        columns = [c for c, _ in declared_columns(parameter.get("column"))] or None
        where = parameter.get("where")
        if kind == "txtfile":
            return self._scan_text(parameter)
        if kind == "hbase":
            return self._scan_cells(parameter)
        if kind not in (*JDBC_KINDS, "hive"):
            raise ValueError(f"unknown source kind: {name}")
        if query and (self.tables or kind == "hive"):
            return extract_query(self.spark, query, columns, where, order_by)
        if query:
            scan = read_jdbc(self.spark, self._options(kind, parameter), None, query, columns, where)
            return extract_table(scan, None, None, order_by)
        if table in self.tables:
            return extract_table(self.tables[table], columns, where, order_by)
        if kind == "hive":
            database = (parameter.get("connection") or {}).get("database")
            full = table if "." in table or not database else f"{database}.{table}"
            return read_catalog_table(self.spark, full, columns, where, order_by)
        options = self._options(kind, parameter)
        split_key = parameter.get("splitPk")
        if not split_key and self.channel > 1:
            split_key = next(iter(self._primary_key(kind, parameter, options)), None)
        scan = read_jdbc(
            self.spark,
            options,
            table,
            None,
            columns,
            where,
            split_key,
            self.channel,
            1 if kind == "odps" else 0,
        )
        return extract_table(scan, None, None, order_by)

    def _primary_key(self, kind: str, parameter: dict, options: dict[str, str]) -> list[str]:
        database = (parameter.get("connection") or {}).get("database")
        return primary_key(self.spark, options, kind, parameter["table"], database)

    def _scan_text(self, parameter: dict) -> DataFrame:
        paths, sep = parameter.get("filePath"), parameter.get("sep", ",")
        if not paths:
            raise ValueError("filePath must not be empty")
        skip = bool(parameter.get("skipHeader", False))
        names = [c for c, _ in declared_columns(parameter.get("column"))]
        if not names:
            # Without declared columns the widest line decides; cells are named by place.
            lines = read_lines(self.spark, paths, skip)
            parts = F.split(F.col("value"), re.escape(separator(sep)), -1)
            width = lines.agg(F.max(F.size(parts))).head()[0] or 1
            names = [str(i) for i in range(width)]
        return read_delimited(self.spark, paths, names, sep, skip)

    def _scan_cells(self, parameter: dict) -> DataFrame:
        cells = self._cell_table(parameter)
        start = stop = None
        if (parameter.get("splitMode") or "region").lower() == "range":
            scan = parameter.get("range") or {}
            start, stop = scan.get("startRowkey"), scan.get("endRowkey")
            if not start or not stop:
                raise ValueError("a range scan needs startRowkey and endRowkey")
            bounds = rowkey_bounds(start, stop, self.channel)
            start, stop = bounds[0], bounds[-1]
        columns = [c for c in parameter.get("column") or [] if isinstance(c, (dict, str))]
        return cells_to_rows(cells, parameter.get("rowkey", "id"), columns, "cf", start, stop)

    def _cell_table(self, parameter: dict) -> DataFrame:
        table = parameter["table"]
        return self.tables[table] if table in self.tables else self.spark.table(table.replace(":", "."))

    # ------------------------------------------------------------- writing

    def _export(self, df: DataFrame, parameter: dict) -> dict:
        """Write an export; rows are counted while writing, files by listing them.

        The rows are watched above any sort: a range shuffle reads its input
        twice, and what lies below it would be counted twice.
        """
        folder = parameter.get("saveUrl")
        if not folder:
            raise ValueError("saveUrl must not be empty")
        # A folder of its own: writing replaces the folder, and saveUrl may hold more.
        path = f"{folder.rstrip('/')}/{re.sub(r'[^0-9A-Za-z_.-]', '_', parameter.get('table') or 'result')}"
        file_type = (parameter.get("fileType") or "csv").lower()
        sep = parameter.get("sep", ",")
        chunk = int(parameter.get("chunkSize") or DEFAULT_CHUNK_ROWS)
        if chunk <= 0:
            raise ValueError("chunkSize must be positive")
        if file_type not in FILE_TYPES:
            raise ValueError(f"unknown fileType: {file_type}")
        counter = RowCounter("exported rows")
        rows = counter.watch(df)
        if parameter.get("isChunk"):
            export_column_chunks(rows, path, chunk, file_type, zone=self.zone)
        elif parameter.get("chunkSize"):
            export_row_chunks(rows, path, chunk, file_type, sep, zone=self.zone)
        elif file_type in ("csv", "txt"):
            export_csv(rows, path, sep, zone=self.zone)
        elif file_type == "json":
            export_json(rows, path, zone=self.zone)
        elif file_type == "parquet":
            export_parquet(rows, path, zone=self.zone)
        else:
            export_orc(rows, path)
        # Names only: no file is opened, and the driver gets one number.
        files = self.spark.read.format("binaryFile").load(path).select("path").count()
        return {
            "colFileNum": files,
            "tableColNum": len(df.columns),
            "tableRowNum": counter.rows,
            "path": path,
        }

    def _write(self, df: DataFrame, name: str, parameter: dict) -> int:
        """Write to the sink; returns the rows it took."""
        kind = name.lower()
        table = parameter.get("table")
        mode = (parameter.get("writeMode") or "insert").lower()
        keys = parameter.get("primaryKey") or []
        if kind == "txtfile":
            return self._write_text(df, parameter)
        declared = declared_columns(parameter.get("column"))
        if kind == "hbase":
            check_write_mode(kind, mode)
            return self._write_cells(df, parameter)
        names = [c for c, _ in declared] or df.columns
        if len(names) > len(df.columns):
            raise ValueError("the writer lists more columns than the reader delivers")
        named = df.select(*[column(s).alias(t) for s, t in zip(df.columns, names)])
        if table in self.tables or kind == "hive" and mode in MERGES:
            return self._merge(df, names, table, mode, keys, parameter.get("orderBy"))
        if kind == "hive":
            return self._load(named, parameter, declared, mode)
        if kind not in JDBC_KINDS:
            raise ValueError(f"unknown sink kind: {name}")
        options = self._options(kind, parameter)
        if mode in ("update", "ignore") and not keys:
            keys = self._primary_key(kind, parameter, options)
        counter = RowCounter("sink rows")
        write_jdbc(counter.watch(named), options, kind, table, mode, keys)
        return counter.rows

    def _write_cells(self, df: DataFrame, parameter: dict) -> int:
        """Add cells under a version of this run, so they win over older ones.

        ``orderBy`` names the reader columns that tell which row of a repeated
        row key was written last; its cells stay.

        The rows are counted in the table: a row key met twice is one row there,
        and a row of nulls is none.
        """
        table, version = parameter["table"], int(time.time() * 1000)
        cells = rows_to_cells(
            df, parameter.get("rowkey", "id"), cell_columns(parameter["column"]), order_by=parameter.get("orderBy")
        ).withColumn("version", F.lit(version).cast("bigint"))
        if table in self.tables:
            self.tables[table] = self.tables[table].unionByName(stage(cells, "cells"))
        else:
            cells.write.mode("append").saveAsTable(table.replace(":", "."))
        return self._cell_table(parameter).where(F.col("version") == version).select("rowkey").distinct().count()

    def _merge(
        self, df: DataFrame, names: list[str], table: str, mode: str, keys: list[str], order_by: str | list[str] | None
    ) -> int:
        """Merge into a named or catalog table; returns the source rows found in it afterwards.

        ``orderBy`` names reader columns that tell which row of a key came first
        (its last one wins, or its first one under ignore). Without it a
        repeated key has no such row, and the job stops. Catalog tables are
        merged by rewriting the files they touch.

        With keys the source rows whose key the merged table holds are counted,
        without keys the rows it gained.
        """
        named = table in self.tables
        target = self.tables[table] if named else self.spark.table(table)
        if mode not in ("insert", "overwrite", *MERGES):
            raise ValueError(f"unknown write mode: {mode}")
        if mode in MERGES and not keys:
            raise ValueError(f"{mode} into a named table needs primaryKey")
        order = [order_by] if isinstance(order_by, str) else list(order_by or [])
        # Order columns ride along under names of their own: the target may have the same ones.
        carried = {f"__order_{i}": o for i, o in enumerate(order if mode in MERGES else [])}
        given = df.select(
            *[column(s).alias(t) for s, t in zip(df.columns, names)], *[column(o).alias(c) for c, o in carried.items()]
        )
        wanted = [target.schema[n] for n in names] + [given.schema[c] for c in carried]
        rows = stage(bind_to_target(given, T.StructType(wanted), zone=self.zone), "merge-source")
        before = target.count() if mode == "insert" and not keys else 0
        if mode == "overwrite":
            self.tables[table] = rows
        elif mode == "insert":
            self.tables[table] = merge_insert(target, rows, keys)
        else:
            if not order:
                per_key = rows.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
                repeated = per_key.where("__n > 1").drop("__n").head(1)
                if repeated:
                    raise ValueError(f"key {repeated[0].asDict()} comes several times: the writer needs orderBy")
            if named:
                self.tables[table] = MERGES[mode](target, rows, keys, order_by=list(carried))
            else:
                merge_table(table, rows, keys, mode, list(carried))
        merged = self.tables[table] if named else self.spark.table(table)
        if mode == "overwrite" or not keys:
            return merged.count() - before
        # Rows, not keys: repeated source rows count as often as they were read.
        return rows_with_keys(rows, merged, keys).count()

    def _load(self, df: DataFrame, parameter: dict, declared, mode: str) -> int:
        check_write_mode("hive", mode)
        kinds = {c: spark_type(k) for c, k in declared}
        explicit = any(isinstance(c, dict) for c in parameter.get("column") or [])
        if explicit:
            schema = T.StructType([T.StructField(c, kinds[c]) for c in df.columns])
            df = bind_to_target(df, schema, zone=self.zone)
        elif self.spark.catalog.tableExists(parameter["table"]):
            target = self.spark.table(parameter["table"]).select(*[column(c) for c in df.columns])
            df = bind_to_target(df, target.schema, zone=self.zone)
        before = self._held(parameter) if mode == "insert" else 0
        load_partition(
            df,
            parameter["table"],
            parameter.get("partition"),
            mode,
            (parameter.get("fileType") or "orc").lower(),
            parameter.get("compress") or "NONE",
            parameter.get("maxFileSize"),
            parameter.get("location"),
            separator(parameter.get("sep", ",")),
        )
        return self._held(parameter) - before

    def _held(self, parameter: dict) -> int:
        """Rows a table or its loaded partition holds; no column is read, so footers tell for columnar files."""
        if not self.spark.catalog.tableExists(parameter["table"]):
            return 0
        rows = self.spark.table(parameter["table"])
        for name, value in parse_partition(parameter.get("partition") or {}).items():
            rows = rows.where(column(name) == F.lit(value).cast(rows.schema[name].dataType))
        return rows.count()

    def _write_text(self, df: DataFrame, parameter: dict) -> int:
        path = parameter.get("filePath")
        if not path:
            raise ValueError("filePath must not be empty")
        file_type = (parameter.get("fileType") or "csv").lower()
        sep = parameter.get("sep", ",")
        header = not parameter.get("skipHeader", True)
        names = [c for c, _ in declared_columns(parameter.get("column"))]
        if header and not names:
            raise ValueError("a header needs the column names")
        if names and len(names) == len(df.columns):
            df = df.toDF(*names)
        chunk = int(parameter.get("chunkSize") or -1)
        if chunk > 0:
            export_row_chunks(df, path, chunk, file_type, sep, header, zone=self.zone, plain=True)
        elif file_type in ("csv", "txt"):
            write_delimited(df, path, sep, header, zone=self.zone)
        elif file_type == "json":
            export_json(df, path, zone=self.zone)
        elif file_type == "parquet":
            export_parquet(df, path, zone=self.zone)
        elif file_type == "orc":
            export_orc(df, path)
        else:
            raise ValueError(f"unknown fileType: {file_type}")
        return written_rows(self.spark, path, file_type, header)

    # ------------------------------------------------------------- running

    def _statements(self, parameter: dict, name: str, key: str) -> None:
        given = parameter.get(key) or []
        statements = [given] if isinstance(given, str) else given
        if not statements:
            return
        if name.lower() in JDBC_KINDS and parameter.get("table") not in self.tables:
            run_statements(self.spark, self._options(name.lower(), parameter), statements)
        else:
            for statement in statements:
                execute(self.spark, statement)

    def _run_export(self) -> dict:
        name, parameter = self._side("common")
        source = self._scan(name, parameter, parameter.get("orderby"))
        rows = apply_chain(source, self.content.get("transformer"))
        return self._export(rows, parameter)

    def _run_script(self) -> dict:
        name, parameter = self._side("common")
        if name.lower() in JDBC_KINDS and (parameter.get("connection") or parameter.get("url")):
            # Scripts are Spark SQL on Spark's tables; a connection must not be passed over in silence.
            raise ValueError(f"scripts run in Spark SQL, not on the {name} connection of this job")
        path = (parameter.get("sqlFile") or "").strip()
        text = Path(path).read_text(encoding="utf-8") if path else parameter.get("sql") or ""
        result = run_script(self.spark, text)
        if result is None or not (parameter.get("saveUrl") or "").strip():
            return {}
        return self._export(result, parameter)

    def _run_move(self) -> dict:
        reader, source = self._side("reader")
        writer, target = self._side("writer")
        self._statements(source, reader, "preSql")
        self._statements(target, writer, "preSql")
        counter = RowCounter("read rows")
        try:
            scan = canonicalize(self._scan(reader, source))
            rows = apply_chain(scan, self.content.get("transformer"))
            written = self._write(counter.watch(rows), writer, target)
            return CountCheck(counter.rows, written).as_dict()
        finally:
            if self.setting.get("enablePostCheck", True):
                self._statements(source, reader, "postSql")
                self._statements(target, writer, "postSql")

    def run(self) -> dict:
        """Run the job; the report is returned and written if the job asks for it."""
        started = time.time()
        mode = int(self.body.get("sqlMode", MOVE))
        runs = {EXPORT: self._run_export, SCRIPT: self._run_script, MOVE: self._run_move}
        report = {
            "code": SUCCESS,
            "sqlMode": str(mode),
            "commonName": (self.content.get("common") or {}).get("name", ""),
            "readerName": (self.content.get("reader") or {}).get("name", ""),
            "writerName": (self.content.get("writer") or {}).get("name", ""),
            "msg": "ok",
            "data": {},
        }
        try:
            if mode not in runs:
                raise ValueError(f"unknown sqlMode: {mode}")
            report["data"] = runs[mode]()
        except Exception:
            report.update(code=FAILED, msg="failed", stackTrace=traceback.format_exc())
            raise
        finally:
            report["costTime"] = int((time.time() - started) * 1000)
            path = self.setting.get("reportPath")
            if path and path.strip():
                Path(path).parent.mkdir(parents=True, exist_ok=True)
                Path(path).write_text(json.dumps(report, ensure_ascii=False), encoding="utf-8")
        return report


def run_job(spark: SparkSession, job: dict, tables: Mapping[str, DataFrame] | None = None) -> dict:
    return Job(spark, job, tables).run()
