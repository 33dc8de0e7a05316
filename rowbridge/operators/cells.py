"""Wide-column cell tables: one row per (rowkey, family, qualifier, value, version).

Integers are 8-byte big-endian, doubles their IEEE-754 bits, booleans one byte,
text UTF-8. Encoding and decoding are arithmetic on JVM-side columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column
from rowbridge.functions.kinds import convert, render

# Fixed values of the IEEE-754 double layout.
_BIAS = 1023
_MANTISSA = 1 << 52
_MIN_NORMAL = 2.2250738585072014e-308
_MIN_SUBNORMAL = 4.9e-324
_NAN_BITS = 0x7FF8000000000000
_INF_BITS = 0x7FF0000000000000


@dataclass(frozen=True)
class CellColumn:
    """A declared column: ``family:qualifier`` and its kind."""

    name: str
    kind: str = "string"

    @property
    def family(self) -> str:
        return self.name.partition(":")[0]

    @property
    def qualifier(self) -> str:
        return self.name.partition(":")[2]


def cell_columns(declared: Sequence[dict | CellColumn | str], family: str = "cf") -> list[CellColumn]:
    """Declared columns; a name without a family gets ``family``."""
    result = []
    for item in declared:
        if isinstance(item, CellColumn):
            result.append(item)
            continue
        name, kind = (item, "string") if isinstance(item, str) else (item["name"], item.get("type", "string"))
        result.append(CellColumn(name if ":" in name else f"{family}:{name}", kind.lower()))
    return result


def _is_rowkey(col: CellColumn, row_key: str) -> bool:
    return col.name == row_key or col.qualifier == row_key


# ----------------------------------------------------------------- encoding


def long_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def with_double_bits(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace double columns by their IEEE-754 bits as a bigint.

    The steps are projections of their own, so each is computed once per row.
    """
    two = F.lit(2.0)
    names = list(names)
    if not names:
        return df
    # log2 may miss the exponent by one next to a power of two.
    guess = df.withColumns(
        {f"__e{i}": F.least(F.floor(F.log2(F.abs(column(c)))), F.lit(_BIAS)) for i, c in enumerate(names)}
    )
    scaled = guess.withColumns(
        {f"__m{i}": F.abs(column(c)) / F.pow(two, F.col(f"__e{i}")) for i, c in enumerate(names)}
    )
    shift = {
        i: F.when(F.col(f"__m{i}") < 1.0, -1).when(F.col(f"__m{i}") >= 2.0, 1).otherwise(0)
        for i in range(len(names))
    }
    exact = scaled.withColumns(
        {
            **{f"__e{i}": F.col(f"__e{i}") + shift[i] for i in shift},
            **{f"__m{i}": F.col(f"__m{i}") / F.pow(two, shift[i]) for i in shift},
        }
    )
    bits = {}
    for i, name in enumerate(names):
        value, size = column(name), F.abs(column(name))
        normal = (F.col(f"__e{i}") + _BIAS) * F.lit(_MANTISSA) + (
            (F.col(f"__m{i}") - 1.0) * float(_MANTISSA)
        ).cast("bigint")
        magnitude = (
            F.when(size == float("inf"), F.lit(_INF_BITS))
            .when(size == 0.0, F.lit(0).cast("bigint"))
            .when(size < _MIN_NORMAL, (size / F.lit(_MIN_SUBNORMAL)).cast("bigint"))
            .otherwise(normal)
        )
        # The sign of -0.0 shows only in its text.
        negative = (value < 0) | ((value == 0) & F.startswith(value.cast("string"), F.lit("-")))
        signed = F.when(negative, magnitude.bitwiseOR(F.lit(-(1 << 63)))).otherwise(magnitude)
        bits[name] = F.when(F.isnan(value), F.lit(_NAN_BITS)).when(value.isNotNull(), signed)
    return exact.withColumns({quoted_name: bits[quoted_name] for quoted_name in names}).drop(
        *[f"__{k}{i}" for k in "em" for i in range(len(names))]
    )


def encode_cell(value: Column, data_type: T.DataType, kind: str) -> Column:
    """Bytes of a cell of the declared kind; doubles come as their bits."""
    if kind in ("int", "long"):
        return long_bytes(convert(value, data_type, "LONG"))
    if kind == "bool":
        flag = convert(value, data_type, "BOOL")
        return F.when(flag, F.unhex(F.lit("FF"))).when(~flag, F.unhex(F.lit("00")))
    if kind == "bytes":
        return convert(value, data_type, "BYTES")
    return F.encode(render(value, data_type), "UTF-8")


def _write_order(df: DataFrame, name: str) -> Column:
    """Whole numbers as they are, times in microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return column(name).cast("bigint")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_micros(column(name).cast("timestamp"))
    raise ValueError(f"{name} does not order writes: it is {kind.simpleString()}")


def rows_to_cells(
    df: DataFrame,
    row_key: str,
    columns: Sequence[dict | CellColumn | str] | None = None,
    family: str = "cf",
    order_by: str | None = None,
) -> DataFrame:
    """One cell per non-null value; the row key itself is not stored.

    ``columns`` follow the order of ``df``. With ``order_by``, a whole number or
    a time, the rows are writes in that order and only the last write of each
    cell remains; its version is that number, or the time in microseconds.
    """
    declared = cell_columns(columns or [c for c in df.columns if c != order_by], family)
    names = [c for c in df.columns if c != order_by or any(d.qualifier == c for d in declared)]
    if len(declared) > len(names):
        raise ValueError("more columns are declared than the rows have")
    keyed = [i for i, c in enumerate(declared) if _is_rowkey(c, row_key)]
    if not keyed:
        raise ValueError(f"row key is not among the columns: {row_key}")
    stored = [(c, n) for c, n in zip(declared, names) if not _is_rowkey(c, row_key)]
    key_field = df.schema[names[keyed[0]]]
    version = _write_order(df, order_by) if order_by else F.lit(0).cast("bigint")
    doubles = [n for c, n in stored if c.kind == "double"]
    typed = df.withColumns(
        {"__rowkey": render(column(key_field.name), key_field.dataType), "__version": version}
    ).withColumns({n: convert(column(n), df.schema[n].dataType, "DOUBLE") for n in doubles})
    ready = with_double_bits(typed, doubles)
    cells = F.array(
        *[
            F.struct(
                F.lit(c.family).alias("family"),
                F.lit(c.qualifier).alias("qualifier"),
                (
                    long_bytes(column(name))
                    if c.kind == "double"
                    else encode_cell(column(name), df.schema[name].dataType, c.kind)
                ).alias("value"),
            )
            for c, name in stored
        ]
    )
    exploded = ready.select(
        F.col("__rowkey").alias("rowkey"), F.col("__version").alias("version"), F.inline(cells)
    ).where(F.col("value").isNotNull())
    cells = exploded.select("rowkey", "family", "qualifier", "value", "version")
    return latest_cells(cells) if order_by else cells


def latest_cells(cells: DataFrame) -> DataFrame:
    """The last write of every cell; combines before the shuffle."""
    newest = F.max(F.struct("version", "value")).alias("newest")
    return (
        cells.groupBy("rowkey", "family", "qualifier")
        .agg(newest)
        .select("rowkey", "family", "qualifier", "newest.value", "newest.version")
    )


# ----------------------------------------------------------------- decoding


def bytes_long(value: Column) -> Column:
    """Big-endian integer of 8 or 4 bytes."""
    digits = F.hex(value)
    wide = F.when(
        (F.length(digits) == 8) & (F.substring(digits, 1, 1) >= "8"),
        F.concat(F.lit("FFFFFFFF"), digits),
    ).otherwise(digits)
    return F.conv(wide, 16, -10).cast("bigint")


def bits_double(bits: Column) -> Column:
    """Double of IEEE-754 bits held in a bigint."""
    exponent = F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(0x7FF))
    fraction = bits.bitwiseAND(F.lit(_MANTISSA - 1))
    normal = (1.0 + fraction / F.lit(float(_MANTISSA))) * F.pow(
        F.lit(2.0), (exponent - _BIAS).cast("double")
    )
    size = (
        F.when((exponent == 0x7FF) & (fraction != 0), F.lit(float("nan")))
        .when(exponent == 0x7FF, F.lit(float("inf")))
        .when(exponent == 0, fraction.cast("double") * F.lit(_MIN_SUBNORMAL))
        .otherwise(normal)
    )
    return F.when(bits < 0, -size).otherwise(size)


def decode_cell(value: Column, kind: str, bits: Column | None = None) -> Column:
    """Typed value of a cell; bytes that fit no form give null.

    ``bits`` is the big-endian long of an 8-byte value, needed for doubles.

    A missing or empty cell is the empty text for text columns, else null.
    """
    width = F.octet_length(value)
    text = F.make_valid_utf8(value.cast("string"))
    digits = F.rlike(text, F.lit(r"^-?[0-9]+\z"))
    if kind in ("int", "long"):
        wide = "int" if kind == "int" else "bigint"
        binary = (width == 8) | (width == 4) if kind == "int" else width == 8
        # Text of exactly 4 or 8 digits reads as binary, like any 4 or 8 bytes.
        return (
            F.when(binary, bytes_long(value).try_cast(wide))
            .when(digits, text.try_cast(wide))
            .otherwise(F.lit(None).cast(wide))
        )
    if kind == "double":
        number = F.rlike(text, F.lit(r"^-?[0-9]+(\.[0-9]+)?\z"))
        return F.when(width == 8, bits_double(bits)).when(number, text.try_cast("double"))
    if kind == "bool":
        return F.when(width == 1, F.hex(value) != "00").when(
            F.lower(text).isin("true", "false"), F.lower(text) == "true"
        )
    if kind == "bytes":
        return F.when(width > 0, value)
    return F.coalesce(text, F.lit(""))


def cells_to_rows(
    cells: DataFrame,
    row_key: str,
    columns: Sequence[dict | CellColumn | str],
    family: str = "cf",
    start_row: str | None = None,
    stop_row: str | None = None,
) -> DataFrame:
    """One typed row per row key, columns named by their qualifier.

    The scan range ``[start_row, stop_row)`` compares row keys as text. Each
    (rowkey, column) is reduced to its newest cell while aggregating, so a row
    key with many versions is combined before the shuffle.
    """
    declared = cell_columns(columns, family)
    if not any(_is_rowkey(c, row_key) for c in declared):
        raise ValueError(f"row key is not among the columns: {row_key}")
    scan = cells
    if start_row:
        scan = scan.where(F.col("rowkey") >= start_row)
    if stop_row:
        scan = scan.where(F.col("rowkey") < stop_row)
    has_version = "version" in cells.columns
    version = F.col("version") if has_version else F.lit(0)
    stored = [(i, c) for i, c in enumerate(declared) if not _is_rowkey(c, row_key)]
    newest = [
        F.max(
            F.when(
                (F.col("family") == c.family) & (F.col("qualifier") == c.qualifier),
                F.struct(version.alias("version"), F.col("value").alias("value")),
            )
        ).alias(f"__c{i}")
        for i, c in stored
    ]
    if not newest:
        newest = [F.count(F.lit(1)).alias("__n")]
    rows = scan.groupBy("rowkey").agg(*newest)
    values = rows.select("rowkey", *[F.col(f"__c{i}.value").alias(f"__c{i}") for i, _ in stored])
    # The bits of a double are looked at several times but read once.
    ready = values.withColumns(
        {
            f"__b{i}": F.when(F.octet_length(f"__c{i}") == 8, bytes_long(F.col(f"__c{i}")))
            for i, c in stored
            if c.kind == "double"
        }
    )
    return ready.select(
        *[
            F.col("rowkey").alias(c.qualifier)
            if _is_rowkey(c, row_key)
            else decode_cell(F.col(f"__c{i}"), c.kind, F.col(f"__b{i}")).alias(c.qualifier)
            for i, c in enumerate(declared)
        ]
    )
