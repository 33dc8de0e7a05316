"""JSON Lines, Parquet and ORC exports and their projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column
from rowbridge.functions.kinds import DATE, kind_of, render


def dates_as_text(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Dates and timestamps in their text form, other columns unchanged."""
    return df.select(
        *[
            render(column(f.name), f.dataType, zone).alias(f.name)
            if kind_of(f.dataType) == DATE
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def export_json(df: DataFrame, path: str, mode: str = "overwrite", zone: str | None = None) -> None:
    """One object per line, keys in column order, null keys omitted."""
    writer = dates_as_text(df, zone).write.mode(mode).option("ignoreNullFields", "true")
    writer.json(path)


def export_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "none",
    zone: str | None = None,
) -> None:
    dates_as_text(df, zone).write.mode(mode).parquet(path, compression=compression)


def legacy_orc(df: DataFrame) -> DataFrame:
    """Longs for longs, booleans and dates (epoch ms), doubles, else text; no nulls."""
    cells = []
    for field in df.schema.fields:
        cell, data_type = column(field.name), field.dataType
        if isinstance(data_type, (T.IntegralType, T.BooleanType)):
            cell = cell.cast("int") if isinstance(data_type, T.BooleanType) else cell
            cell = F.coalesce(cell.cast("bigint"), F.lit(0).cast("bigint"))
        elif kind_of(data_type) == DATE:
            seconds = F.date_trunc("second", cell.cast("timestamp"))
            cell = F.coalesce(F.unix_millis(seconds), F.lit(0).cast("bigint"))
        elif isinstance(data_type, (T.FloatType, T.DoubleType)):
            cell = F.coalesce(cell.cast("string").cast("double"), F.lit(float("nan")))
        else:
            cell = F.coalesce(render(cell, data_type), F.lit(""))
        cells.append(cell.alias(field.name))
    return df.select(*cells)


def export_orc(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "none",
    legacy_nulls: bool = False,
) -> None:
    """ORC with nulls kept; ``legacy_nulls`` writes 0, NaN and empty text instead."""
    rows = legacy_orc(df) if legacy_nulls else df
    rows.write.mode(mode).orc(path, compression=compression.lower())
