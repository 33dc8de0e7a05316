from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.functions import kinds

TEXT = T.StringType()


def converted(spark, values, source, target, on_error="null"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {source.simpleString()}")
    out = df.select("i", kinds.convert(F.col("v"), source, target, on_error).alias("c"))
    return [r.c for r in out.orderBy("i").collect()]


def test_text_to_long(spark):
    cases = {
        "12.7": 12,
        "-12.7": -12,
        "+3": 3,
        ".5": 0,
        "5.": 5,
        "1.2345e2": 123,
        "-1.9E0": -1,
        "9.999999999999999999e0": 9,
        "9.223372036854775807E18": 2**63 - 1,
        "9.223372036854775808E18": None,
        "9.9E19": None,
        "15.000e2": 1500,
        "123456789012345678901e0": None,
        "1e999999999": None,
        "0.0e50": 0,
        "-0.123456789012345678e+18": -123456789012345678,
        "9.9999999999999999999999e0": 9,
        "99999999999999999999e-20": 0,
        "0.00000000000000000012345e20": 12,
        "-9223372036854775808": -(2**63),
        "9223372036854775808": None,
        "1e19": None,
        "5e99999999999": None,
        "0000000000000000000000042": 42,
        "1e-999999": 0,
        "": None,
        " 5": None,
        "yes": None,
        "NaN": None,
    }
    assert converted(spark, list(cases), TEXT, "LONG") == list(cases.values())


def test_text_to_double(spark):
    cases = ["1.5", "1e400", "-1e400", "1e-400", "0e5", "Infinity", "-Infinity", "infinity", "1d", "x"]
    expected = [1.5, None, None, None, 0.0, float("inf"), -float("inf"), None, None, None]
    assert converted(spark, cases, TEXT, "DOUBLE") == expected


def test_text_to_bool(spark):
    assert converted(spark, ["TRUE", "false", "yes", "1", None], TEXT, "BOOL") == [True, False, None, None, None]


def test_text_to_date_cascade(spark):
    got = converted(
        spark, ["2024-01-02 03:04:05", "2024-01-02", "03:04:05", "2024-13-45", "2024-01-02 extra"], TEXT, "DATE"
    )
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), datetime(1970, 1, 1, 3, 4, 5), None, None]


@pytest.mark.parametrize(
    "source, target, value",
    [
        (T.StringType(), "LONG", "x"),
        (T.StringType(), "BOOL", "1"),
        (T.DoubleType(), "BOOL", 1.0),
        (T.BooleanType(), "DATE", True),
        (T.LongType(), "BYTES", 1),
        (T.BinaryType(), "LONG", b"1"),
        (T.DateType(), "DOUBLE", datetime(2024, 1, 1).date()),
        (T.DoubleType(), "LONG", 1e300),
        (T.DoubleType(), "LONG", float("nan")),
        (T.LongType(), "INT", 2**40),
    ],
)
def test_strict_conversion_raises_but_not_on_null(spark, source, target, value):
    with pytest.raises(PySparkException):
        converted(spark, [value], source, target, "raise")
    assert converted(spark, [None], source, target, "raise") == [None]
    assert converted(spark, [value], source, target, "null") == [None]


def test_other_conversions(spark):
    assert converted(spark, [1.9, -1.9, 4e18], T.DoubleType(), "LONG") == [1, -1, 4 * 10**18]
    assert converted(spark, [0, 5], T.LongType(), "BOOL") == [False, True]
    assert converted(spark, [True, False], T.BooleanType(), "LONG") == [1, 0]
    assert converted(spark, [1500], T.LongType(), "DATE") == [datetime(1970, 1, 1, 0, 0, 1, 500000)]
    assert converted(spark, [datetime(1970, 1, 1, 0, 0, 1, 500999)], T.TimestampType(), "LONG") == [1500]
    assert converted(spark, ["é".encode(), b"\xff"], T.BinaryType(), "STRING") == ["é", "�"]


def test_plain_doubles(spark):
    rng = random.Random(5)
    values = [1.23456789123e8, 1e10, 1e-5, 5.0, -1.5e7, 0.0, 12345.678, 1e21, -2.5e-300, 1.7976931348623157e308, 1e20, 9.9e19]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 30) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(F.col("v").cast("string").alias("t"), kinds.render(F.col("v"), T.DoubleType()).alias("p"))
    for row in rows.collect():
        assert row.p == format(Decimal(row.t), "f")
    assert [r.v for r in kinds.render_text(df).collect()][:4] == ["123456789.123", "10000000000", "0.000010", "5.0"]


def test_zone_of_text(spark):
    df = spark.sql("select timestamp '2024-01-01 20:00:00 UTC' as t, date '2024-01-01' as d")
    row = kinds.render_text(df, zone="GMT+8").head()
    assert (row.t, row.d) == ("2024-01-02 04:00:00", "2024-01-01")


def test_canonical_kinds(spark):
    df = spark.sql(
        "select cast(1 as tinyint) a, 2 b, cast(1.5 as decimal(4,2)) c, cast(0.1 as float) d,"
        " timestamp '2024-01-01 00:00:00.123456' e, true f"
    )
    out = kinds.canonicalize(df)
    assert out.dtypes == [
        ("a", "string"), ("b", "bigint"), ("c", "string"), ("d", "double"), ("e", "timestamp"), ("f", "boolean"),
    ]
    row = out.head()
    assert (row.a, row.c, row.d, row.e.microsecond) == ("1", "1.50", 0.1, 123000)


def test_text_of_a_time_the_session_zone_skips(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz '2024-03-10 02:30:00.5' n, timestamp '2024-03-09 18:30:00 UTC' t")
        row = kinds.render_text(df, zone="GMT+8").head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.n, row.t) == ("2024-03-10 02:30:00", "2024-03-10 02:30:00")
