"""Delimited text without quoting, written as plain lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column
from rowbridge.functions.kinds import BYTES, STRING, kind_of, render_text
from rowbridge.operators.report import RowCounter
from rowbridge.sources.delimited import separator


def clean_cell(cell: Column) -> Column:
    """Newlines and commas become a space, whatever the separator is."""
    return F.translate(cell, "\n,", "  ")


def text_cell(cell: Column, data_type: T.DataType) -> Column:
    """A rendered cell ready for a line; only free text can need cleaning."""
    free = kind_of(data_type) in (STRING, BYTES) and not isinstance(data_type, T.IntegralType)
    return F.coalesce(clean_cell(cell) if free else cell, F.lit(""))


def delimited_rows(
    df: DataFrame, sep: str | None = ",", zone: str | None = None, plain: bool = True
) -> DataFrame:
    """One line of text per row in ``value``; nulls are empty cells."""
    text = render_text(df, zone, plain)
    cells = [text_cell(column(f.name), f.dataType) for f in df.schema.fields]
    return text.select(F.concat_ws(separator(sep), *cells).alias("value"))


def with_header(lines: DataFrame, header: str, others: list[str] | None = None) -> DataFrame:
    """Put the header in front of the first line of every partition.

    The low 33 bits of ``monotonically_increasing_id`` are the place of a row in
    its partition, so this stays a narrow JVM-side step.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    both = F.array(F.lit(header), F.col("value"))
    shown = F.when(place == 0, both).otherwise(F.array("value"))
    return lines.select(*(others or []), F.explode(shown).alias("value"))


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str | None = ",",
    header: bool = False,
    mode: str = "overwrite",
    zone: str | None = None,
    plain: bool = True,
) -> int:
    """Write text lines, one file per partition; returns the rows written.

    With ``header`` every file starts with the column names; an empty result
    still leaves one file holding them.
    """
    counter = RowCounter("delimited rows")
    lines = counter.watch(delimited_rows(df, sep, zone, plain))
    title = separator(sep).join(df.columns)
    if header:
        lines = with_header(lines, title)
    # A record limit set for the session would cut files without a header.
    lines.write.mode(mode).option("maxRecordsPerFile", 0).text(path)
    if header and counter.rows == 0:
        spark = df.sparkSession
        empty = spark.range(0, 1, 1, 1).select(F.lit(title).alias("value"))
        empty.write.mode("append").text(path)
    return counter.rows


def export_csv(
    df: DataFrame, path: str, sep: str | None = ",", header: bool = True, zone: str | None = None
) -> int:
    """Table export: header line, doubles in their shortest text form."""
    return write_delimited(df, path, sep, header, zone=zone, plain=False)
