"""Changes of catalog tables by the files they touch."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowbridge.operators import merges
from rowbridge.operators.merges import DuplicateKeyError
from rowbridge.plans.script import run_script
from rowbridge.sinks import touched
from rowbridge.sinks.touched import delete_from, files_of, in_files, merge_table, update_table


@pytest.fixture
def stock(spark, tmp_path):
    """Shelves of goods in files of ten ids; one shelf has no name, one a difficult one."""
    place = tmp_path / "my shelves"
    shelf = "case when id < 10 then 'a b' when id < 20 then null when id < 30 then 'c/d=é' else 'e' end as shelf"
    rows = spark.range(0, 40, 1, 4).selectExpr("id", "concat('good ', id) as label", "id * 1.5 as price", shelf)
    spark.sql(f"create table stock (id bigint, label string, price double, shelf string) using parquet partitioned by (shelf) location '{place}'")
    rows.write.insertInto("stock")
    yield place
    spark.sql("drop table if exists stock")


def files(place):
    return {p.relative_to(place).as_posix(): p.read_bytes() for p in place.rglob("part-*")}


def rows_of(spark, name="stock"):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=repr)


def test_delete_rewrites_only_files_with_a_hit(spark, stock):
    before = files(stock)
    gone = delete_from(spark, "stock", "id in (12, 25) or price is null")
    after = files(stock)
    assert len(gone) == 2 and len(before) == 4
    kept = {n for n in before if "a%20b" in n or "a b" in n or "shelf=e" in n}
    assert len(kept) == 2 and all(after[n] == before[n] for n in kept)
    assert len(set(after) & set(before)) == 2
    assert sorted(r[0] for r in rows_of(spark)) == [i for i in range(40) if i not in (12, 25)]
    assert not list(stock.glob("_rewrite-*"))
    assert delete_from(spark, "stock", "id = 12") == [] and files(stock) == after
    assert len(delete_from(spark, "stock", "shelf = 'e'")) == 1
    assert spark.table("stock").where("shelf = 'e'").count() == 0


def test_update_moves_rows_between_partitions(spark, stock):
    before = files(stock)
    update_table(spark, "stock", "id between 8 and 11", {"shelf": "'new %25'", "price": "price + 1"})
    found = spark.table("stock").where("shelf = 'new %25'").orderBy("id").collect()
    assert [(r.id, r.price) for r in found] == [(i, i * 1.5 + 1) for i in range(8, 12)]
    assert spark.table("stock").count() == 40
    assert sum(after == before.get(n) for n, after in files(stock).items()) == 2


def test_only_the_files_named_are_opened(spark, stock):
    table = spark.table("stock")
    one = files_of(table.where("id = 25"))
    plan = in_files(table, one)
    plan.collect()
    metrics = plan._jdf.queryExecution().executedPlan().toString()
    assert len(one) == 1 and plan.count() == 10
    leaves = plan._jdf.queryExecution().executedPlan().collectLeaves()
    read = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
    assert read == [1], metrics


@pytest.mark.parametrize("mode", ["ignore", "update", "replace"])
def test_merges_equal_those_of_whole_tables(spark, stock, mode):
    source = spark.createDataFrame(
        [(3, "later", "a b", 2), (3, "first", "e", 1), (14, None, None, 1), (77, "new", "f", 1), (78, "new", "a b", 1)],
        "id bigint, label string, shelf string, seq int",
    )
    before, table = files(stock), spark.table("stock")
    merge = {"ignore": merges.merge_ignore, "update": merges.merge_update, "replace": merges.merge_replace}[mode]
    expected = sorted((tuple(r) for r in merge(table, source, ["id"], "seq").collect()), key=repr)
    gone = merge_table("stock", source, ["id"], mode, "seq")
    assert rows_of(spark) == expected and len(expected) == 42
    after = files(stock)
    assert len(gone) == (0 if mode == "ignore" else 2)
    assert sum(after.get(n) == content for n, content in before.items()) == 4 - len(gone)


def test_insert_adds_files_and_refuses_known_keys(spark, stock):
    before = files(stock)
    source = spark.createDataFrame([(100, "x")], "id bigint, label string")
    merge_table("stock", source, ["id"], "insert")
    assert spark.table("stock").where("id = 100 and price is null and shelf is null").count() == 1
    assert before.items() <= files(stock).items()
    with pytest.raises(DuplicateKeyError):
        merge_table("stock", source, "id", "insert")
    with pytest.raises(ValueError, match="mode"):
        merge_table("stock", source, "id", "upsert")
    with pytest.raises(Exception, match="null in key"):
        merge_table("stock", source.withColumn("id", F.lit(None).cast("bigint")), "id", "update")
    assert spark.table("stock").count() == 41 and not list(stock.glob("_rewrite-*"))


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_a_committed_change_is_finished_by_the_next(spark, stock, monkeypatch, steps):
    """The driver is lost while files are swapped, after some of the moves."""
    swap, moved = touched._swap, []

    def lost(spark, table, files, journal):
        swap(spark, table, files, {**journal, "moves": journal["moves"][:steps], "removes": [], "partitioned": False})
        moved.append(len(journal["moves"]))
        raise ConnectionError("driver lost")

    monkeypatch.setattr(touched, "_swap", lost)
    with pytest.raises(ConnectionError):
        update_table(spark, "stock", "id % 10 = 5", {"label": "'five'", "shelf": "concat('n', id)"})
    monkeypatch.undo()
    assert moved[0] > steps and list(stock.glob("_rewrite-*"))
    assert touched.finish_rewrites(spark, "stock") == 1
    assert spark.table("stock").count() == 40 and not list(stock.glob("_rewrite-*"))
    found = spark.table("stock").where("label = 'five'").orderBy("id").collect()
    assert [(r.id, r.shelf) for r in found] == [(i, f"n{i}") for i in (5, 15, 25, 35)]


def test_an_uncommitted_change_leaves_no_trace(spark, stock, monkeypatch):
    before = files(stock)

    def lost(*_):
        raise ConnectionError("driver lost")

    monkeypatch.setattr(touched, "_commit", lost)
    with pytest.raises(ConnectionError):
        delete_from(spark, "stock", "id < 15")
    monkeypatch.undo()
    assert list(stock.glob("_rewrite-*")) and spark.table("stock").count() == 40
    assert touched.finish_rewrites(spark, "stock") == 0
    assert files(stock) == before and not list(stock.glob("_rewrite-*"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rewrite_")]


@pytest.mark.parametrize("kind", ["csv options (sep '|')", "orc", "json"])
def test_other_formats_without_partitions(spark, tmp_path, kind):
    spark.sql(f"create table plain (id int, v varchar(9)) using {kind} location '{tmp_path}/plain'")
    try:
        for part in ("(1, 'a'), (2, 'b')", "(3, 'c'), (4, null)"):
            spark.sql(f"insert into plain select * from values {part}")
        before = files(Path(tmp_path / "plain"))
        run_script(spark, "update plain set v = upper(v) where id = 2 or id = 1; delete from plain where v = 'A'")
        assert rows_of(spark, "plain") == [(2, "B"), (3, "c"), (4, None)]
        # A file may hold one row or two: those of the second insert stay in any case.
        assert len(before.items() & files(Path(tmp_path / "plain")).items()) >= 1
        run_script(spark, "delete from plain")
        assert rows_of(spark, "plain") == []
    finally:
        spark.sql("drop table if exists plain")
