"""Exports cut by row count and by column."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowbridge.common import column, local_rows, session_setting, staged_path, staging
from rowbridge.functions.kinds import render
from rowbridge.operators.numbering import column_chunks, number_rows, row_chunks
from rowbridge.sinks.columnar import dates_as_text
from rowbridge.sinks.delimited import clean_cell, text_cell
from rowbridge.sources.delimited import separator

# Fixed values of the export layout.
DEFAULT_CHUNK_ROWS = 1_000_000
INDEX_DIGITS = 10
INDEX_FILE = "indexMap.json"
# Fixed value: what Spark allows a table by default.
MOST_BUCKETS = 100_000

TEXT_TYPES = ("csv", "txt", "text")


def _lines(rows: DataFrame, groups: Sequence[str], value: Column, first: Column, header: Column | None) -> DataFrame:
    """Lines in the order of ``row_id`` within each chunk, its header line in front.

    The order is fixed by one sort after the only shuffle; what follows keeps the
    chunk columns in front, so the writer has no reason to sort again.
    """
    if header is None:
        listed = rows.select(*groups, "row_id", F.lit(1).alias("__place"), value.alias("value"))
    else:
        line = F.struct(F.lit(1).alias("__place"), value.alias("value"))
        title = F.struct(F.lit(0).alias("__place"), header.alias("value"))
        both = F.when(first, F.array(title, line)).otherwise(F.array(line))
        listed = rows.select(*groups, "row_id", F.inline(both))
    moved = listed.repartition(*groups).sortWithinPartitions(*groups, "row_id", "__place")
    return moved.select(*groups, "value")


def _writer(df: DataFrame, groups: Sequence[str]):
    # A record limit set for the session would cut chunks once more.
    return df.write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy(*groups)


def export_row_chunks(
    df: DataFrame,
    path: str,
    rows: int = DEFAULT_CHUNK_ROWS,
    file_type: str = "csv",
    sep: str | None = ",",
    header: bool = True,
    order_by: Sequence[str] | None = None,
    zone: str | None = None,
    plain: bool = False,
) -> None:
    """One folder ``chunk_id=<i>`` per chunk, holding one file of at most ``rows`` rows.

    Rows move once, by chunk. A chunk has a fixed size, so the work per task does
    not depend on how the data is distributed.
    """
    with staging(df.sparkSession):
        chunked = row_chunks(df, rows, order_by)
        if file_type in TEXT_TYPES:
            cells = [
                text_cell(render(column(f.name), f.dataType, zone, plain), f.dataType)
                for f in df.schema.fields
            ]
            sep = separator(sep)
            title = F.lit(sep.join(df.columns)) if header else None
            first = F.col("row_id") % rows == 0
            lines = _lines(chunked, ["chunk_id"], F.concat_ws(sep, *cells), first, title)
            _writer(lines, ["chunk_id"]).text(path)
        else:
            moved = chunked.repartition("chunk_id").sortWithinPartitions("chunk_id", "row_id")
            data = moved.drop("row_id")
            data = data if file_type == "orc" else dates_as_text(data, zone)
            _writer(data, ["chunk_id"]).option("compression", "none").format(file_type).save(path)


def column_chunk_rows(
    df: DataFrame,
    order_by: Sequence[str] | None = None,
    zone: str | None = None,
    plain: bool = False,
) -> DataFrame:
    """(row_id, col_idx, value): rows are numbered once, so columns stay aligned."""
    numbered = number_rows(df, order_by)
    cells = [render(column(f.name), f.dataType, zone, plain).alias(f.name) for f in df.schema.fields]
    return column_chunks(numbered.select("row_id", *cells))


def export_column_chunks(
    df: DataFrame,
    path: str,
    rows: int = DEFAULT_CHUNK_ROWS,
    file_type: str = "csv",
    header: bool = True,
    order_by: Sequence[str] | None = None,
    zone: str | None = None,
    plain: bool = False,
) -> dict[str, str]:
    """One folder ``col_idx=<0000000001>`` per column, cut into row chunks.

    Text columns are written by one job over the long form. Typed formats keep
    each column's type, so every column is a job reading that column alone; rows
    are shuffled to their chunks once, whatever the number of columns.
    Returns the name -> index map, which is also written next to the folders.
    """
    path = path.rstrip("/")
    with staging(df.sparkSession):
        if file_type in TEXT_TYPES:
            _export_text_columns(df, path, rows, header, order_by, zone, plain)
        else:
            _export_typed_columns(df, path, rows, file_type, order_by, zone)
    index = {name: str(i) for i, name in enumerate(df.columns, 1)}
    text = local_rows(df.sparkSession, {"value": [json.dumps(index, ensure_ascii=False)]}, "value string")
    text.write.mode("overwrite").text(f"{path}/_{INDEX_FILE}")
    return index


def _export_text_columns(df, path, rows, header, order_by, zone, plain) -> None:
    long = column_chunk_rows(df, order_by, zone, plain)
    padded = long.withColumns(
        {
            "chunk_id": F.call_function("div", F.col("row_id"), F.lit(rows)),
            "col_idx": F.lpad(F.col("col_idx").cast("string"), INDEX_DIGITS, "0"),
        }
    )
    name = F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("col_idx").cast("int"))
    value = F.coalesce(clean_cell(F.col("value")), F.lit(""))
    groups = ["col_idx", "chunk_id"]
    lines = _lines(padded, groups, value, F.col("row_id") % rows == 0, name if header else None)
    _writer(lines, groups).text(path)


def _export_typed_columns(df, path, rows, file_type, order_by, zone) -> None:
    """Rows move once, into buckets by chunk; a column's job reads whole buckets.

    A chunk then lies in one task without another shuffle, and a file source
    reads only the column asked for. The buckets are a table of this run.
    """
    spark = df.sparkSession
    data = df if file_type == "orc" else dates_as_text(df, zone)
    chunked = row_chunks(data, rows, order_by)
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    table = f"rowbridge_columns_{uuid.uuid4().hex}"
    staged = chunked.repartition(buckets, "chunk_id").write.bucketBy(buckets, "chunk_id")
    staged.sortBy("chunk_id", "row_id").option("path", staged_path(spark, "columns")).saveAsTable(table)
    try:
        # Otherwise Spark cuts files by size where no join or aggregate asks for buckets.
        with session_setting(spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):
            for i, name in enumerate(df.columns, 1):
                cells = typed_column(spark.table(table), name)
                writer = _writer(cells, ["chunk_id"]).option("compression", "none")
                writer.format(file_type).save(f"{path}/col_idx={i:0{INDEX_DIGITS}d}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def typed_column(bucketed: DataFrame, name: str) -> DataFrame:
    """(chunk_id, column) in the order of the rows, from rows in buckets by chunk."""
    ordered = bucketed.select("chunk_id", "row_id", column(name)).sortWithinPartitions("chunk_id", "row_id")
    return ordered.select("chunk_id", column(name))
