"""Fitting rows to a target table before they are written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column
from rowbridge.functions.kinds import convert


def fit_to_width(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Cut text longer than the target's column; 0 means no limit."""
    return df.select(
        *[
            F.substring(column(f.name), 1, widths[f.name]).alias(f.name)
            if isinstance(f.dataType, T.StringType) and widths.get(f.name, 0) > 0
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Read the empty text, a pair of quotes and NULL in any case as null."""
    wanted = df.columns if columns is None else columns
    cells = []
    for field in df.schema.fields:
        cell = column(field.name)
        if field.name in wanted and isinstance(field.dataType, T.StringType):
            empty = cell.isin("", '""') | (F.upper(cell) == "NULL")
            cell = F.when(~empty, cell).alias(field.name)
        cells.append(cell)
    return df.select(*cells)


def _kind(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.StringType):
        return "STRING"
    if isinstance(data_type, T.IntegerType):
        return "INT"
    if isinstance(data_type, T.LongType):
        return "LONG"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    if isinstance(data_type, T.BooleanType):
        return "BOOL"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "DATE"
    if isinstance(data_type, T.BinaryType):
        return "BYTES"
    return None


def bind_to_target(
    df: DataFrame,
    schema: T.StructType,
    widths: Mapping[str, int] | None = None,
    on_error: str = "raise",
    zone: str | None = None,
) -> DataFrame:
    """Convert cells by position to the target's types and names.

    Types outside the kinds (decimals, small ints) take Spark's cast.
    """
    cells = []
    for source, target in zip(df.schema.fields, schema.fields):
        cell, kind = column(source.name), _kind(target.dataType)
        if source.dataType == target.dataType:
            pass
        elif kind is None:
            cell = cell.cast(target.dataType) if on_error == "raise" else cell.try_cast(target.dataType)
        else:
            cell = convert(cell, source.dataType, kind, on_error, zone).cast(target.dataType)
        cells.append(cell.alias(target.name))
    bound = df.select(*cells)
    return fit_to_width(bound, widths) if widths else bound
