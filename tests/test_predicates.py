"""Range scans that open only the files a range can be in."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowbridge.operators.splits import read_range_partitioned
from rowbridge.sources import predicates
from rowbridge.sources.predicates import FileBounds, file_bounds, predicate_scan, range_scans


@pytest.fixture
def sorted_files(spark, tmp_path):
    """Ten files of a hundred neighbouring keys each, one of nulls, one of both."""
    folder = tmp_path / "some table"
    folder.mkdir()
    for i in range(10):
        keys = list(range(i * 100, i * 100 + 100))
        pq.write_table(pa.table({"k": pa.array(keys, pa.int64()), "v": [f"v{k % 7}" for k in keys]}), folder / f"f{i}.parquet")
    pq.write_table(pa.table({"k": pa.array([None] * 5, pa.int64()), "v": ["none"] * 5}), folder / "nulls.parquet")
    pq.write_table(pa.table({"k": pa.array([None, 555], pa.int64()), "v": ["none", "late"]}), folder / "both.parquet")
    return str(folder)


def same(left, right):
    return Counter(map(tuple, left.collect())) == Counter(map(tuple, right.collect()))


def test_each_range_opens_the_files_that_can_hold_it(spark, sorted_files):
    table = spark.read.parquet(sorted_files)
    bounds = file_bounds(table, sorted_files, "k")
    assert sum(b.rows for b in bounds) == 1007 and all(b.known for b in bounds)
    scans = range_scans(bounds, "k", 5)
    opened = [sorted(f.rsplit("/", 1)[1].split(".")[0] for f in s.files) for s in scans]
    assert opened == [["f0", "f1"], ["f2", "f3"], ["both", "f4", "f5"], ["f6", "f7"], ["f8", "f9"], ["both", "nulls"]]
    # Twelve files, opened thirteen times instead of seventy-two.
    assert sum(map(len, opened)) == 13


@pytest.mark.parametrize("n", [1, 3, 5, 64])
@pytest.mark.parametrize("where", [None, "v <> 'v3' or v is null", "k between 120 and 480"])
def test_equals_the_tagged_read(spark, sorted_files, n, where):
    table = spark.read.parquet(sorted_files)
    assert same(predicate_scan(spark, sorted_files, "k", n, where), read_range_partitioned(table, "k", n, where))


def files_opened(df):
    """Files of every scan of a plan that ran, by Spark's own metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]


def test_no_other_file_is_opened(spark, sorted_files):
    read = predicate_scan(spark, sorted_files, "k", 5)
    assert files_opened(read) == [2, 2, 3, 2, 2, 2]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("GreaterThanOrEqual(k,") == 4 and plan.count("LessThan(k,") == 4


def test_a_store_that_only_spark_opens(spark, sorted_files, monkeypatch):
    table = spark.read.parquet(sorted_files)
    told = predicates.file_bounds(table, sorted_files, "k")
    unread = [FileBounds(b.path, -1, None, None, None) for b in told]
    monkeypatch.setattr(predicates, "_footers", lambda *_: unread)
    assert predicates.file_bounds(table, sorted_files, "k") == told
    assert predicates._footer("viewfs://store/a.parquet", "k") is None


def test_files_without_statistics_are_opened_by_all_ranges(spark, sorted_files):
    extra = pa.table({"k": pa.array([-7, 250, None, 4000], pa.int64()), "v": ["a", "b", "c", "d"]})
    pq.write_table(extra, f"{sorted_files}/untold.parquet", write_statistics=False)
    bounds = file_bounds(spark.read.parquet(sorted_files), sorted_files, "k")
    untold = [b for b in bounds if b.path.endswith("untold.parquet")]
    assert untold == [FileBounds(untold[0].path, 4, None, None, None)] and not untold[0].known
    read = predicate_scan(spark, sorted_files, "k", 5)
    assert same(read.select("k", "v"), spark.read.parquet(sorted_files).select("k", "v"))
    held = {r["k"]: r["split_id"] for r in read.where("v in ('a', 'b', 'c', 'd')").collect()}
    assert held == {-7: 0, 250: 1, None: 5, 4000: 4}


def test_partitions_empty_tables_and_late_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(300).select("id", (F.col("id") % 3).cast("int").alias("day"))
    rows.write.partitionBy("day").parquet(path)
    assert same(predicate_scan(spark, path, "id", 4, columns=["day", "id"]).select("day", "id"), rows.select("day", "id"))

    none = str(tmp_path / "none")
    rows.where("false").write.parquet(none)
    assert predicate_scan(spark, none, "id", 4).collect() == []

    late = str(tmp_path / "late")
    spark.range(10).write.parquet(late)
    spark.range(10, 20).select("id", F.col("id").alias("extra")).write.mode("append").parquet(late)
    schema = spark.range(1).select("id", F.col("id").alias("extra")).schema
    read = predicate_scan(spark, late, "extra", 2, schema=schema)
    assert same(read.select("id", "extra"), spark.read.schema(schema).parquet(late))
    assert read.where("extra is null").select("split_id").distinct().collect()[0][0] == 2


def test_only_nulls_and_keys_that_are_no_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select(F.lit(None).cast("bigint").alias("k"), "id", F.col("id").cast("string").alias("s")).write.parquet(path)
    assert sorted(r["split_id"] for r in predicate_scan(spark, path, "k", 4).collect()) == [0, 0, 0]
    for key in ("s", "missing"):
        with pytest.raises(ValueError, match="whole-number"):
            predicate_scan(spark, path, key, 4)
