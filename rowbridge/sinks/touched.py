"""Changes to catalog tables that rewrite only the files they touch.

A change first names the files that hold a hit, then writes the new content of
these files next to the table, and last swaps the two by a journal. Files
without a hit keep their names and bytes.

The journal lists the files to move in and those to remove. It appears by one
rename, which is the commit: a driver lost before leaves the table as it was,
one lost after is finished by the next change, as every step may be repeated.
Between commit and end a reader may see old and new files together. A table
takes one change at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowbridge.common import column, staging
from rowbridge.operators.merges import (
    added_by_ignore,
    added_by_insert,
    merge_replace,
    merge_update,
    rows_with_keys,
)
from rowbridge.sinks.partitions import delete_where, update_where

_FOLDER, _JOURNAL = "_rewrite-", "journal.json"
_FILE = "__file"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}


def file_backed(spark: SparkSession, table: str) -> bool:
    """Whether the table's rows come with the file they lie in."""
    return _details(spark, table).get("Provider", "").lower() in ("parquet", "orc", "csv", "json", "avro")


def _files(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, uri: str):
    """The path of an escaped URI, as file metadata and input lists give it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def in_files(rows: DataFrame, files: Sequence[str]) -> DataFrame:
    """The rows that lie in the given files; the others are not opened."""
    return rows.where(F.col("_metadata.file_path").isin(list(files))) if files else rows.where(F.lit(False))


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_FILE, F.col("_metadata.file_path"))


def files_of(hits: DataFrame) -> list[str]:
    """Files of the rows of a table, tagged with them or not yet joined.

    The driver gets one path per file with a hit, as it does when it plans a scan.
    """
    tagged = hits if _FILE in hits.columns else _with_file(hits)
    return sorted(r[0] for r in tagged.select(_FILE).distinct().collect())


def finish_rewrites(spark: SparkSession, table: str) -> int:
    """Complete committed changes and drop uncommitted ones; returns those completed."""
    place = _details(spark, table)["Location"]
    files = _files(spark, place)
    done = 0
    for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, f"{_FOLDER}*")) or []:
        folder = found.getPath()
        journal = spark._jvm.org.apache.hadoop.fs.Path(folder, _JOURNAL)
        if files.exists(journal):
            stream = files.open(journal)
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            _swap(spark, table, files, json.loads(text))
            done += 1
        files.delete(folder, True)
    if done:
        spark.catalog.refreshTable(table)
    return done


def _swap(spark: SparkSession, table: str, files, journal: Mapping) -> None:
    """Move new files in, then remove old ones; what is done already is passed over."""
    new_folder = False
    for old, new in journal["moves"]:
        source, target = _path(spark, old), _path(spark, new)
        if not files.exists(source):
            continue
        if not files.exists(target.getParent()):
            files.mkdirs(target.getParent())
            new_folder = True
        if not files.rename(source, target):
            raise OSError(f"cannot move {old} to {new}")
    # A run that was cut short may have made folders the catalog does not know yet.
    if journal["partitioned"] and (new_folder or journal.get("again")):
        spark.sql(f"MSCK REPAIR TABLE {table}")
    for old in journal["removes"]:
        files.delete(_path(spark, old), False)


def replace_files(spark: SparkSession, table: str, gone: Sequence[str], rows: DataFrame) -> None:
    """Swap the files ``gone`` for ``rows``, which may be computed from them.

    A sibling table of the same format and options below the table's own folder
    takes the new files, so they move within one file system. Rows of a
    partitioned table are rebalanced by partition first: every partition gets
    few files, and a partition holding most rows is split.
    """
    place = _details(spark, table)["Location"]
    parts = _partition_columns(spark, table)
    folder = f"{place.rstrip('/')}/{_FOLDER}{uuid.uuid4().hex}"
    database = f"{table.rsplit('.', 1)[0]}." if "." in table else ""
    sibling = f"{database}rewrite_{uuid.uuid4().hex}"
    literal = f"{folder}/data".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {sibling} LIKE {table} LOCATION '{literal}'")
    try:
        listed = rows.select(*[column(c) for c in spark.table(table).columns])
        if parts:
            listed = listed.hint("rebalance", *[column(p) for p in parts])
        listed.write.insertInto(sibling)
        spark.catalog.refreshTable(sibling)
        new = spark.table(sibling).inputFiles()
    finally:
        spark.sql(f"DROP TABLE {sibling}")
    inside = f"/{folder.rsplit('/', 1)[1]}/data/"
    moves = [[uri, "/".join(uri.rsplit(inside, 1))] for uri in new]
    _commit(spark, table, folder, {"moves": moves, "removes": list(gone), "partitioned": bool(parts)})


def _commit(spark: SparkSession, table: str, folder: str, journal: Mapping) -> None:
    files = _files(spark, folder)
    make = spark._jvm.org.apache.hadoop.fs.Path
    draft, final = make(folder, "draft"), make(folder, _JOURNAL)
    files.mkdirs(make(folder))
    stream = files.create(draft, True)
    try:
        # What a later change finds is a second attempt: it looks for new folders in any case.
        stream.write(bytearray(json.dumps({**journal, "again": True}).encode()))
    finally:
        stream.close()
    if not files.rename(draft, final):
        raise OSError(f"cannot commit the change of {table}")
    _swap(spark, table, files, journal)
    files.delete(make(folder), True)
    spark.catalog.refreshTable(table)


def delete_from(spark: SparkSession, table: str, condition: str) -> list[str]:
    """Delete the rows for which the condition is true; returns the files rewritten."""
    finish_rewrites(spark, table)
    rows = spark.table(table)
    touched = files_of(rows.where(F.expr(condition)))
    if touched:
        replace_files(spark, table, touched, delete_where(in_files(rows, touched), condition))
    return touched


def update_table(spark: SparkSession, table: str, condition: str, assignments: Mapping[str, str]) -> list[str]:
    """Set columns where the condition is true; returns the files rewritten."""
    finish_rewrites(spark, table)
    rows = spark.table(table)
    touched = files_of(rows.where(F.expr(condition)))
    if touched:
        replace_files(spark, table, touched, update_where(in_files(rows, touched), condition, assignments))
    return touched


def merge_table(
    table: str,
    source: DataFrame,
    keys: str | Sequence[str] = (),
    mode: str = "update",
    order_by: str | Sequence[str] | None = None,
) -> list[str]:
    """Merge rows into a catalog table by insert, ignore, update or replace; returns the files rewritten.

    Insert and ignore only add files. Update and replace find the files holding
    a source key by a semi join that reads the table's key columns alone (Spark
    adds a Bloom filter of the smaller side where that join shuffles) and merge
    within these files. All rows with a source key lie there, so the
    result is that of a merge over the whole table.
    """
    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    finish_rewrites(spark, table)
    target = spark.table(table)
    touched: list[str] = []
    with staging(spark):
        if mode == "insert":
            rows = added_by_insert(target, source, keys)
        elif mode == "ignore":
            rows = added_by_ignore(target, source, keys, order_by)
        elif mode in ("update", "replace"):
            touched = files_of(rows_with_keys(_with_file(target), source, keys))
            merge = merge_update if mode == "update" else merge_replace
            rows = merge(in_files(target, touched), source, keys, order_by)
        else:
            raise ValueError(f"unknown write mode: {mode}")
        replace_files(spark, table, touched, rows)
    return touched
