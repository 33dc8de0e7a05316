"""Cell kinds, the conversion matrix and the text form of every kind.

Spark's ``cast`` is not the conversion matrix: text such as ``12.7`` converts to
the long 12, only ``true``/``false`` convert to a boolean, and conversions that
the matrix lacks are errors. Everything here is built from JVM-side functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column

STRING, LONG, INT, DOUBLE, BOOL, DATE, BYTES = (
    "STRING",
    "LONG",
    "INT",
    "DOUBLE",
    "BOOL",
    "DATE",
    "BYTES",
)

# Declared kind -> Spark type, and the accepted date formats in
# the order they are tried.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "LONG": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "DATE": T.TimestampType(),
    "BYTES": T.BinaryType(),
}
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH:mm:ss"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_ORDINARY = r"^[+-]?[0-9]{1,19}(\.[0-9]*)?\z"
_SCIENTIFIC = r"^[+-]?[1-9][0-9]*(\.[0-9]{1,18})?[eE]\+?[0-9]+\z"
_ORDINARY_DOUBLE = r"^[+-]?[0-9]{1,19}(\.[0-9]{0,19})?([eE][+-]?[0-9]{1,2})?\z"
_ZERO = r"^[+-]?[0.]+([eE].*)?\z"
_TWO_53 = float(1 << 53)
_LARGEST = 1.7976931348623157e308


def kind_of(data_type: T.DataType) -> str:
    """Kind a scanned column gets: small ints and decimals travel as text."""
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        return LONG
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return DOUBLE
    if isinstance(data_type, T.BooleanType):
        return BOOL
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    if isinstance(data_type, T.BinaryType):
        return BYTES
    return STRING


def spark_type(declared: str | None) -> T.DataType:
    """Spark type of a declared kind name; no declaration means text."""
    name = (declared or STRING).strip().upper()
    if name not in SPARK_TYPES:
        raise ValueError(f"unknown column type: {declared}")
    return SPARK_TYPES[name]


# --------------------------------------------------------------- text form


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    The lambda also keeps ``use`` out of the generated code, where a large
    expression repeated over many columns would exceed what the JVM compiles;
    it suits the rare branch of a conditional.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _large_text(text: Column) -> Column:
    """Digits of a double of 1e20 and more: always a whole number."""

    def digits(t: Column) -> Column:
        mantissa = F.substring_index(t, "E", 1)
        frac = F.substring_index(mantissa, ".", -1)
        places = F.substring_index(t, "E", -1).cast("int")
        return F.concat(F.substring_index(mantissa, ".", 1), F.rpad(frac, places, F.lit("0")))

    return bound(text, digits)


def plain_text(text: Column) -> Column:
    """Decimal text of a double's shortest text without an exponent, same digits."""
    small = F.concat(
        F.when(F.startswith(text, F.lit("-")), "-0.").otherwise("0."),
        F.repeat(F.lit("0"), F.substring_index(text, "E-", -1).cast("int") - 1),
        F.translate(F.substring_index(text, "E", 1), ".-", ""),
    )
    # Such a number has at most 20 whole digits and fewer than 18 after the point.
    exact = text.cast("decimal(38,18)").cast("string")
    medium = F.rtrim(F.rtrim(exact, F.lit("0")), F.lit("."))
    return (
        F.when(~F.contains(text, F.lit("E")), text)
        .when(F.contains(text, F.lit("E-")), small)
        .when(F.rlike(text, F.lit("E1?[0-9]$")), medium)
        .otherwise(_large_text(text))
    )


def _shortest(value: Column, data_type: T.DataType) -> Column:
    """Java text of a double; a float counts as the double its text names."""
    if isinstance(data_type, T.FloatType):
        return value.cast("string").cast("double").cast("string")
    return value.cast("string")


def _at_zone(value: Column, zone: str | None) -> Column:
    """Wall-clock time of an instant in ``zone`` (session zone when None)."""
    local = value.cast("timestamp_ntz")
    if zone is None:
        return local
    return F.convert_timezone(F.current_timezone(), F.lit(zone), local)


def _second_text(local: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock time, whatever the session zone skips."""
    return F.substring(local.cast("string"), 1, 19)


def render(value: Column, data_type: T.DataType, zone: str | None = None, plain: bool = True) -> Column:
    """Text form of a cell; null stays null."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        text = _shortest(value, data_type)
        return plain_text(text) if plain else text
    if isinstance(data_type, T.TimestampType):
        return _second_text(_at_zone(value, zone))
    if isinstance(data_type, T.TimestampNTZType):
        return _second_text(value)
    if isinstance(data_type, T.BinaryType):
        return F.make_valid_utf8(value.cast("string"))
    return value.cast("string")


def render_text(df: DataFrame, zone: str | None = None, plain: bool = True) -> DataFrame:
    """Every cell as text.

    Doubles are formatted in a projection of their own, as their text is then
    looked at more than once.
    """
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    text = df.select(
        *[render(column(f.name), f.dataType, zone, plain=False).alias(f.name) for f in df.schema.fields]
    )
    if not plain or not doubles:
        return text
    return text.select(
        *[plain_text(column(c)).alias(c) if c in doubles else column(c) for c in text.columns]
    )


def canonicalize(df: DataFrame) -> DataFrame:
    """Bring a scan to the cell kinds: long, double, text, bool, ms dates, bytes."""
    cells = []
    for field in df.schema.fields:
        cell, kind = column(field.name), kind_of(field.dataType)
        if kind == LONG:
            cell = cell.cast("bigint")
        elif isinstance(field.dataType, T.FloatType):
            cell = cell.cast("string").cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            cell = F.date_trunc("millisecond", cell)
        elif isinstance(field.dataType, T.TimestampNTZType):
            cell = F.date_trunc("millisecond", cell).cast("timestamp_ntz")
        elif kind == STRING:
            cell = cell.cast("string")
        cells.append(cell.alias(field.name))
    return df.select(*cells)


# --------------------------------------------------------------- numbers


def _moved_point(text: Column) -> Column:
    """Integer part of number text with an exponent or many digits.

    The decimal point is moved in the digits themselves, so neither rounding
    nor a decimal width limit can change the truncated value.
    """

    def digits(number: Column) -> Column:
        mantissa = F.ltrim(F.substring_index(number, "e", 1), F.lit("+-"))
        exponent = F.when(
            F.contains(number, F.lit("e")), F.substring_index(number, "e", -1).try_cast("int")
        ).otherwise(0)
        return F.struct(
            F.replace(mantissa, F.lit("."), F.lit("")).alias("digits"),
            F.length(F.substring_index(mantissa, ".", 1)).alias("whole"),
            exponent.cast("bigint").alias("exponent"),
            F.startswith(number, F.lit("-")).alias("negative"),
        )

    def stripped(parts: Column) -> Column:
        significant = F.ltrim(parts["digits"], F.lit("0"))
        zeros = F.length(parts["digits"]) - F.length(significant)
        return F.struct(
            significant.alias("digits"),
            (parts["whole"] + parts["exponent"] - zeros).alias("point"),
            F.when(parts["negative"], "-").otherwise("").alias("sign"),
        )

    def shifted(parts: Column) -> Column:
        whole = F.rpad(parts["digits"], F.least(parts["point"], F.lit(20)).cast("int"), F.lit("0"))
        zero = (F.length(parts["digits"]) == 0) | (parts["point"] <= 0)
        return F.when(parts["point"].isNull(), None).when(zero, F.lit(0).cast("bigint")).when(
            parts["point"] <= 19, F.concat(parts["sign"], whole).try_cast("bigint")
        )

    return bound(bound(bound(F.lower(text), digits), stripped), shifted)


def long_value(text: Column) -> Column:
    """Number text truncated toward zero; null when not a number or out of range."""

    def rare(t: Column) -> Column:
        return F.when(F.rlike(t, F.lit(_NUMBER)), _moved_point(t))

    short = F.substring_index(text, ".", 1).try_cast("bigint")
    # Up to 18 digits after the point, moved to the left, fit the decimal unrounded;
    # what has too many digits before the point for it is beyond a long as well.
    shifted = text.try_cast("decimal(38,18)").try_cast("bigint")
    return (
        F.when(F.rlike(text, F.lit(_ORDINARY)), short)
        .when(F.rlike(text, F.lit(_SCIENTIFIC)), shifted)
        .otherwise(bound(text, rare))
    )


def double_value(text: Column) -> Column:
    """Number text as a double; null when not a number, too large or too small."""

    def rare(t: Column) -> Column:
        value = t.try_cast("double")
        finite = F.when((value != 0) | F.rlike(t, F.lit(_ZERO)), value)
        return F.when(t.isin("NaN", "Infinity", "-Infinity"), value).when(
            F.rlike(t, F.lit(_NUMBER)) & (F.abs(value) <= F.lit(_LARGEST)), finite
        )

    ordinary = F.rlike(text, F.lit(_ORDINARY_DOUBLE))
    return F.when(ordinary, text.try_cast("double")).otherwise(bound(text, rare))


def out_of_range(text: Column, kind: str) -> Column:
    """True for numeric text that the kind cannot hold."""
    value = long_value(text) if kind == LONG else double_value(text)
    number = F.rlike(text, F.lit(_NUMBER))
    return F.coalesce(number & value.isNull(), F.lit(False))


def validate_range(df: DataFrame, name: str, kind: str = LONG) -> DataFrame:
    """Rows whose numeric text overflows ``kind``."""
    return df.where(out_of_range(column(name), kind))


# --------------------------------------------------------------- dates


def parse_dates(text: Column) -> Column:
    """Date-time, then date, then time of day; null when none fits."""
    return F.coalesce(
        *[F.try_to_timestamp(text, F.lit(f)) for f in (DATETIME_FORMAT, DATE_FORMAT, TIME_FORMAT)]
    )


# --------------------------------------------------------------- conversion


def _checked(source: Column, value: Column, target: str, on_error: str) -> Column:
    """``value`` is null for a bad cell; a bad cell raises unless nulls are wanted."""
    if on_error == "null":
        return value
    message = F.concat(F.lit(f"cannot convert to {target}: "), source.cast("string"))
    return F.coalesce(value, F.when(source.isNotNull(), F.raise_error(message)))


def convert(
    value: Column,
    source: T.DataType,
    target: str,
    on_error: str = "raise",
    zone: str | None = None,
) -> Column:
    """Convert a cell of type ``source`` to the kind ``target``.

    ``on_error="raise"`` fails the job on the first bad cell, ``"null"`` turns
    bad cells into nulls.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be raise or null, not {on_error}")
    target = target.upper()
    kind = kind_of(source)
    result = SPARK_TYPES[target]

    def checked(converted: Column) -> Column:
        return _checked(value, converted.cast(result), target, on_error)

    if target == INT:
        return checked(convert(value, source, LONG, on_error, zone).try_cast("int"))
    if target == STRING:
        return render(value, source, zone)
    if kind == STRING:
        text = value.cast("string")
        if target == BYTES:
            return F.encode(text, "UTF-8")
        if target == LONG:
            return checked(long_value(text))
        if target == DOUBLE:
            return checked(double_value(text))
        if target == BOOL:
            lowered = F.lower(text)
            return checked(F.when(lowered == "true", True).when(lowered == "false", False))
        return checked(parse_dates(text))
    if kind == LONG:
        if target in (LONG, DOUBLE):
            return value.cast(result)
        if target == BOOL:
            return value != 0
        if target == DATE:
            return F.timestamp_millis(value)
    if kind == DOUBLE:
        if target == DOUBLE:
            return value.cast(result)
        if target == LONG:
            # Below 2^53 the digits of a double and its exact value truncate alike.
            small = F.when(F.abs(value) < _TWO_53, value.cast("bigint"))
            return checked(F.coalesce(small, long_value(_shortest(value, source))))
    if kind == BOOL:
        if target == BOOL:
            return value
        if target in (LONG, DOUBLE):
            return value.cast("int").cast(result)
    if kind == DATE:
        if target == DATE:
            return value
        if target == LONG:
            return F.unix_millis(value.cast("timestamp"))
    if kind == BYTES and target == BYTES:
        return value
    return checked(F.lit(None))
