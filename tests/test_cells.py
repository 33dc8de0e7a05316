from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from rowbridge.operators.cells import cells_to_rows, latest_cells, rows_to_cells

DECLARED = [
    {"name": "cf:id", "type": "string"},
    {"name": "cf:i", "type": "int"},
    {"name": "cf:l", "type": "long"},
    {"name": "cf:d", "type": "double"},
    {"name": "cf:b", "type": "bool"},
    {"name": "cf:s", "type": "string"},
    {"name": "cf:y", "type": "bytes"},
]
SCHEMA = "id string, i int, l bigint, d double, b boolean, s string, y binary"


def bits(value):
    return struct.pack(">d", value)


def special_doubles():
    rng = random.Random(3)
    values = [0.0, -0.0, 1.0, -1.5, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]
    values += [float("inf"), float("-inf"), float("nan")]
    values += [2.0**k for k in range(-1074, 1024, 7)]
    values += [math.nextafter(2.0**k, 0.0) for k in range(-1000, 1024, 7)]
    values += [struct.unpack(">d", struct.pack(">Q", rng.getrandbits(64)))[0] for _ in range(500)]
    return values


def test_round_trip(spark):
    values = special_doubles()
    rows = [
        (str(n), n - 300, (n - 300) * 2**40, v, n % 2 == 0, f"文{n}" if n % 5 else "", bytes([n % 256]) * 9)
        for n, v in enumerate(values)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    back = {r.id: r for r in cells_to_rows(rows_to_cells(df, "id", DECLARED), "id", DECLARED).collect()}
    assert len(back) == len(rows)
    for row in rows:
        got = back[row[0]]
        assert (got.i, got.l, got.b, got.s, bytes(got.y)) == (*row[1:3], *row[4:6], bytes(row[6]))
        assert bits(got.d) == bits(row[3]) or (math.isnan(got.d) and math.isnan(row[3]))


def test_encoding(spark):
    df = spark.createDataFrame([("1", -1, 2, 1.5, True, "é", b"\x00")], SCHEMA)
    cells = {r.qualifier: bytes(r.value) for r in rows_to_cells(df, "id", DECLARED).collect()}
    assert cells == {
        "i": struct.pack(">q", -1),
        "l": struct.pack(">q", 2),
        "d": struct.pack(">d", 1.5),
        "b": b"\xff",
        "s": "é".encode(),
        "y": b"\x00",
    }


def test_nulls_store_no_cell(spark):
    df = spark.createDataFrame([("1", None, 2, None, None, None, None)], SCHEMA)
    cells = rows_to_cells(df, "id", DECLARED)
    assert [r.qualifier for r in cells.collect()] == ["l"]
    row = cells_to_rows(cells, "id", DECLARED).head()
    assert (row.i, row.l, row.d, row.b, row.s, row.y) == (None, 2, None, None, "", None)


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("int", struct.pack(">i", -2147483648), -2147483648),
        ("int", struct.pack(">i", 7), 7),
        ("int", b"18", 18),
        ("int", b"-3", -3),
        ("int", b"x", None),
        ("int", b"99999999999", None),
        ("long", struct.pack(">q", -5), -5),
        ("long", b"123456789012", 123456789012),
        ("long", b"12.5", None),
        ("double", b"12.5", 12.5),
        ("double", b"1e5", None),
        ("bool", b"\x00", False),
        ("bool", b"\x07", True),
        ("bool", b"TRUE", True),
        ("bool", b"no", None),
        ("string", b"", ""),
        ("int", b"", None),
        ("bytes", b"\x01\x02", b"\x01\x02"),
    ],
)
def test_decoding(spark, kind, value, expected):
    cells = spark.createDataFrame([("r", "cf", "v", value, 1)], "rowkey string, family string, qualifier string, value binary, version long")
    row = cells_to_rows(cells, "id", ["cf:id", {"name": "cf:v", "type": kind}]).head()
    got = bytes(row.v) if kind == "bytes" else row.v
    assert (row.id, got) == ("r", expected)


def test_text_cells_of_the_visitors(spark, three):
    declared = [
        {"name": "cf1:id", "type": "string"},
        {"name": "cf1:name", "type": "string"},
        {"name": "cf1:height", "type": "int"},
    ]
    cells = [
        (r.id, "cf1", q, str(v).encode(), 1)
        for r in three.collect()
        for q, v in (("id", r.id), ("name", r.name), ("height", r.height))
    ]
    df = spark.createDataFrame(cells, "rowkey string, family string, qualifier string, value binary, version long")
    rows = [tuple(r) for r in cells_to_rows(df, "id", declared).orderBy("id").collect()]
    assert rows == [("1", "Ødegård", 158), ("2", "Šárka", 172), ("3", "Ng Wei", 190)]
    ranged = cells_to_rows(df, "id", declared, start_row="2", stop_row="3").collect()
    assert [r.id for r in ranged] == ["2"]


def test_last_write_wins(spark):
    df = spark.createDataFrame([("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", None, 9)], "id string, v string, seq long")
    cells = rows_to_cells(df, "id", ["id", "v"], order_by="seq")
    assert [(r.rowkey, bytes(r.value), r.version) for r in cells.collect()] == [("1", b"b", 3)]
    plan = latest_cells(cells)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_missing_row_key_column(spark, three):
    with pytest.raises(ValueError):
        rows_to_cells(three, "nope")
    with pytest.raises(ValueError):
        cells_to_rows(spark.range(1), "nope", ["cf:id"])


def test_no_python_in_the_codec(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("id"), F.rand().alias("d"))
    declared = ["cf:id", {"name": "cf:d", "type": "double"}]
    plan = cells_to_rows(rows_to_cells(df, "id", declared), "id", declared)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
