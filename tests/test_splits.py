from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowbridge.operators import splits


@pytest.mark.parametrize("lo, hi, n", [(0, 99, 4), (1, 10, 3), (-7, 5, 4), (0, 2, 5), (5, 5, 3), (0, 6, 7)])
def test_ranges_cover_every_key_once(lo, hi, n):
    ranges = splits.split_ranges(lo, hi, n)
    for key in range(lo, hi + 1):
        assert sum(a <= key <= b for a, b in ranges) == 1


def test_fewer_keys_than_splits():
    assert splits.split_ranges(0, 2, 5) == [(0, -1), (0, -1), (0, -1), (0, -1), (0, 2)]
    assert splits.split_ranges(0, 9, 20, min_step=1)[0] == (0, 0)


@pytest.mark.parametrize("n", [1, 3, 7, 200])
def test_every_row_gets_one_split(spark, n):
    keys = [None, -5, -4, 0, 1, 2, 50, 51, 99, 100, 2**40]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r.split_id for r in splits.with_split_id(df, "k", n).collect()}
    ranges = splits.split_ranges(-5, 2**40, n)
    assert got.pop(None) == n
    for key, number in got.items():
        assert ranges[number][0] <= key <= ranges[number][1]
    listed = splits.range_splits(df, "k", n).collect()
    assert sum(r.rows for r in listed) == len(keys)


def test_bounds_beyond_a_long(spark):
    df = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "k bigint")
    assert sorted(r.split_id for r in splits.with_split_id(df, "k", 4).collect()) == [0, 2, 3]


def test_fractional_and_text_keys(spark):
    df = spark.createDataFrame([(0.0,), (1.5,), (9.9,)], "k double")
    assert [r.split_id for r in splits.with_split_id(df, "k", 3).orderBy("k").collect()] == [0, 0, 2]
    text = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r.rows for r in splits.range_splits(text, "k", 3).collect()] == [2]


def test_predicates_partition_the_table(spark):
    df = spark.createDataFrame([(k,) for k in [None, 0.0, 1.5, 2.5, 7.0, 10.0, 42.0]], "k double")
    ranges = splits.split_ranges(0, 42, 3)
    tests = splits.range_predicates("k", ranges, "k is null or k <> 7")
    assert sum(df.where(t).count() for t in tests) == 6
    assert len(tests) == 4


def test_tagging_does_not_shuffle(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    plan = splits.read_range_partitioned(df, "k", 4, "k > 3")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rowkey_ranges(spark):
    assert splits.rowkey_bounds("0", "100", 4) == ["0", "25", "50", "75", "100"]
    assert splits.rowkey_bounds("10", "0", 4) == ["10", "8", "5", "3", "0"]
    assert splits.rowkey_bounds("row1", "row4", 3) == ["row1", "row1_split1", "row1_split2", "row4"]
    keys = spark.createDataFrame([(f"row{i}",) for i in range(6)], "rowkey string")
    got = splits.rowkey_range_splits(keys, "rowkey", "row1", "row4", 2)
    assert sorted((r.rowkey, r.split_id) for r in got.collect()) == [("row1", 0), ("row2", 1), ("row3", 1)]


def test_overlapping_rowkey_ranges_read_a_row_once(spark):
    keys = spark.createDataFrame([(str(i),) for i in range(1, 30)], "rowkey string")
    got = splits.rowkey_range_splits(keys, "rowkey", "1", "25", 3)
    assert got.count() == got.select("rowkey").distinct().count()
    assert splits.rowkey_bounds("1", "25", 3) == ["1", "9", "17", "25"]
    assert got.where(F.col("rowkey") == "2").head().split_id == 0


@pytest.mark.parametrize("drawn", [20, 4096])
def test_regions_hold_every_row_in_even_shares(spark, drawn):
    from rowbridge.operators.splits import region_bounds, rowkey_region_splits

    # Most keys share a long beginning, and one key has a third of the rows.
    keys = spark.range(9000).selectExpr("case when id % 10 = 0 then concat('é', id) else concat('customer/0000/', id) end as k")
    rows = keys.union(spark.range(4500).selectExpr("'customer/0000/7'")).union(spark.range(3).selectExpr("cast(null as string)"))
    tagged = rowkey_region_splits(rows, "k", 4, drawn)
    assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()
    found = {r.split_id: r for r in tagged.groupBy("split_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("k").alias("keys"), F.min("k").alias("low"), F.max("k").alias("high")
    ).collect()}
    assert found.pop(4).rows == 3 and sum(r.rows for r in found.values()) == 13500
    spans = sorted((r.low.encode(), r.high.encode()) for r in found.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert [spans[i][0] for i in range(4)] == sorted(found[i].low.encode() for i in range(4))
    even = 2250 * (0.1 if drawn == 4096 else 0.9)
    assert len(found) == 4 and all(abs(r.keys - 2250) <= even for r in found.values())
    assert region_bounds(rows, "k", 4, drawn) == region_bounds(rows.repartition(7), "k", 4, drawn)


def test_regions_of_few_keys(spark):
    from rowbridge.operators.splits import region_bounds, rowkey_region_splits

    empty = spark.createDataFrame([], "k string, split string")
    assert region_bounds(empty, "k", 3) == [] and rowkey_region_splits(empty, "k", 3).count() == 0
    one = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(r.split_id for r in rowkey_region_splits(one, "k", 3).collect()) == [0, 0, 3]
    numbers = spark.range(12).withColumnRenamed("id", "k")
    assert len({r.split_id for r in rowkey_region_splits(numbers, "k", 3).collect()}) == 3
    with pytest.raises(ValueError):
        region_bounds(one, "k", 0)
