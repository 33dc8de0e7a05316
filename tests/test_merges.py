from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowbridge.operators import merges

TARGET = "k int, r int, name string, amount double"


@pytest.fixture(scope="module")
def target(spark):
    rows = [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (2, 2, None, 3.0), (None, 1, "n", 4.0), (None, 1, "n", 4.0)]
    return spark.createDataFrame(rows, TARGET)


@pytest.fixture(scope="module")
def source(spark):
    rows = [(2, 1, None, 1), (2, 1, "late", 2), (2, 2, None, 3), (9, 9, "new", 4), (9, 9, "newer", 5)]
    return spark.createDataFrame(rows, "k int, r int, name string, seq int")


def listed(df):
    return sorted((tuple(r) for r in df.select("k", "r", "name", "amount").collect()), key=repr)


def check(df, expected):
    assert listed(df) == sorted(expected, key=repr)


NULL_KEYED = [(None, 1, "n", 4.0), (None, 1, "n", 4.0)]
def test_ignore(target, source):
    merged = merges.merge_ignore(target, source, ["k", "r"], "seq")
    check(merged, [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (2, 2, None, 3.0), (9, 9, "new", None), *NULL_KEYED])


def test_update(target, source):
    merged = merges.merge_update(target, source, ["k", "r"], "seq")
    check(merged, [(1, 1, "a", 1.0), (2, 1, "late", 2.0), (2, 2, None, 3.0), (9, 9, "newer", None), *NULL_KEYED])


def test_update_overwrites_with_null(spark, target):
    source = spark.createDataFrame([(1, 1, None)], "k int, r int, name string")
    merged = merges.merge_update(target, source, ["k", "r"])
    assert merged.where("k = 1").head().name is None
    assert merged.where("k = 1").head().amount == 1.0


def test_replace(target, source):
    merged = merges.merge_replace(target, source, ["k", "r"], "seq")
    check(merged, [(1, 1, "a", 1.0), (2, 1, "late", None), (2, 2, None, None), (9, 9, "newer", None), *NULL_KEYED])


def test_insert(spark, target, source):
    fresh = spark.createDataFrame([(7, 1, "x")], "k int, r int, name string")
    merged = merges.merge_insert(target, fresh, ["k", "r"])
    assert merged.count() == 6 and merged.where("k = 7").head().amount is None
    with pytest.raises(merges.DuplicateKeyError):
        merges.merge_insert(target, source.drop("seq").where("k = 2 and r = 2"), ["k", "r"])
    repeated = spark.createDataFrame([(7, 1, "x"), (7, 1, "y")], "k int, r int, name string")
    with pytest.raises(merges.DuplicateKeyError):
        merges.merge_insert(target, repeated, ["k", "r"])
    assert merges.merge_insert(target, repeated).count() == 7


def test_null_source_key_fails(spark, target):
    source = spark.createDataFrame([(None, 1, "x")], "k int, r int, name string")
    with pytest.raises(PySparkException):
        merges.merge_update(target, source, ["k", "r"]).collect()


def test_one_key_may_be_a_name(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert merges.merge_update(df, df.selectExpr("id", "'b' as v"), "id").collect() == [(1, "b")]


def test_unknown_column_fails(spark, target):
    source = spark.createDataFrame([(1, 1, "x")], "k int, r int, nickname string")
    with pytest.raises(ValueError):
        merges.merge_update(target, source, ["k", "r"])


def test_against_plain_python_with_a_hot_key(spark):
    rng = random.Random(7)
    target = {k: (k, f"t{k}", float(k)) for k in range(0, 60, 2)}
    feed = [(rng.choice([8, rng.randrange(80)]), rng.choice([None, f"s{i}"]), i) for i in range(900)]
    t = spark.createDataFrame(list(target.values()), "k int, name string, amount double")
    s = spark.createDataFrame(feed, "k int, name string, seq int").repartition(5)
    first, last = {}, {}
    for k, name, _ in feed:
        first.setdefault(k, name)
        last[k] = name
    got = lambda df: {r.k: (r.k, r.name, r.amount) for r in df.collect()}
    assert got(merges.merge_ignore(t, s, ["k"], "seq")) == {
        **{k: (k, v, None) for k, v in first.items()}, **target
    }
    updated = {k: (k, v, target[k][2] if k in target else None) for k, v in last.items()}
    assert got(merges.merge_update(t, s, ["k"], "seq")) == {**target, **updated}
    assert got(merges.merge_replace(t, s, ["k"], "seq")) == {
        **target, **{k: (k, v, None) for k, v in last.items()}
    }


def test_update_twice_is_update_once(target, source):
    once = merges.merge_update(target, source, ["k", "r"], "seq")
    check(merges.merge_update(once, source, ["k", "r"], "seq"), listed(once))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(1000).withColumn("v", F.lit("x")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(5).withColumn("v", F.lit("y"))
    plan = executed(merges.merge_update(target, source, ["id"], unique=True))
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan


def test_merges_without_keys_are_refused(target, source):
    for merge in (merges.merge_ignore, merges.merge_update, merges.merge_replace):
        with pytest.raises(ValueError, match="key columns"):
            merge(target, source, [])


def test_one_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as seq", "'x' as v")
    plan = executed(merges.one_per_key(df, ["k"], "seq", last=True))
    assert "partial_max_by" in plan and "Window" not in plan
