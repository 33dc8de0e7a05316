from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from rowbridge.common import scratch_path
from rowbridge.plans import pipelines as flows
from rowbridge.plans.script import returns_rows, run_script, split_statements
from rowbridge.sinks.jdbc import check_write_mode, merge_statement
from rowbridge.sources import jdbc
from rowbridge.sources.tables import clean_where, declared_columns, extract_table, read_catalog_table


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_streaks_against_plain_days(spark):
    """Runs over month ends and a leap day, repeated visits in one day, ties, single days."""
    visits = {
        "ada": ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-03"],
        "bo": ["2021-12-31", "2022-01-01", "2021-06-10", "2021-06-11", "2020-05-05"],
        "cy": ["2022-08-08"],
    }
    rows = [(u, f"{d} {h:02d}:59:59") for u, days in visits.items() for d in days for h in (0, 23)]
    events = spark.createDataFrame(rows, "who string, t string").withColumn("seen", F.col("t").cast("timestamp"))
    expected = []
    for who, days in visits.items():
        numbers = sorted(date.fromisoformat(d).toordinal() for d in days)
        runs = [[d for d in numbers if d - numbers.index(d) == key] for key in {d - i for i, d in enumerate(numbers)}]
        longest = max(map(len, runs))
        expected += [
            (who, longest, f"{date.fromordinal(r[0])}..{date.fromordinal(r[-1])}") for r in runs if len(r) == longest
        ]
    got = [tuple(r) for r in flows.longest_streaks(events, "who", "seen", "..").collect()]
    assert got == sorted(expected, key=lambda r: (-r[1], r[0], r[2])) and len(got) == 4


def test_streaks_shuffle_twice(spark):
    logins = spark.range(0, 10, 1, 4).selectExpr("id % 3 as u", "timestamp_seconds(id * 90000) as t")
    plan = executed(flows.longest_streaks(logins, "u", "t", "-", ordered=False))
    assert plan.count("Exchange hashpartitioning") == 2


def test_star_of_harvests(spark):
    """Members keep or get keys in the order of their names; facts take them with text made into numbers and days."""
    rows = spark.createDataFrame(
        [
            ("h-7", "quince", 12, Decimal("3.10"), "2031-02-28", "25%"),
            ("h-2", "fig", 4, Decimal("8.25"), "28/02/2031", "4"),
            ("h-9", "olive", 100, Decimal("0.40"), "09/11/2030", "0"),
            ("h-4", "medlar", 1, None, "later", None),
        ],
        "harvest string, fruit string, baskets int, price decimal(10,2), picked string, rebate string",
    )
    kinds = {"stone": ["olive", "plum"], "seeded": ["quince", "medlar"]}
    members = rows.select("fruit", flows.categorize(F.col("fruit"), kinds, "soft").alias("kind"))
    known = spark.createDataFrame([(7, "olive", "kept")], "fruit_id int, fruit string, kind string")
    fruits = flows.load_dimension(known, members, "fruit", "fruit_id")
    assert {r.fruit: (r.fruit_id, r.kind) for r in fruits.collect()} == {
        "olive": (7, "kept"), "fig": (8, "soft"), "medlar": (9, "seeded"), "quince": (10, "seeded"),
    }
    worth = F.col("baskets") * F.col("price")
    fact = flows.load_fact(rows, [(fruits, "fruit", "fruit_id", "fruit")]).select(
        "harvest", "fruit_id", flows.parse_discount(worth, F.col("rebate")).cast("decimal(10,2)").alias("off"),
        flows.mixed_dates(F.col("picked")).cast("string").alias("day"),
    )
    assert {r.harvest: (r.fruit_id, r.off, r.day) for r in fact.collect()} == {
        "h-7": (10, Decimal("9.30"), "2031-02-28"), "h-2": (8, Decimal("1.32"), "2031-02-28"),
        "h-9": (7, Decimal("0.00"), "2030-11-09"), "h-4": (9, None, None),
    }


def test_star_runs_no_job_to_measure(spark, tmp_path):
    """Joins of facts and dimensions are planned without a look at the rows."""
    rows = spark.range(50).selectExpr("id", "cast(id % 7 as string) as name")
    members = flows.load_dimension(None, rows.select("name"), "name", "key")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("measure", "measure")
    try:
        fact = flows.load_fact(rows, [(members, "name", "key", "name")])
        assert len(tracker.getJobIdsForGroup("measure")) == 0
        assert fact.count() == 50
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


class FakeSession:
    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_follows_the_session():
    assert scratch_path(FakeSession("yarn", "hdfs://shared/x/"), "y").startswith("hdfs://shared/x/rowbridge/y-")
    assert scratch_path(FakeSession("local[2]"), "y") != scratch_path(FakeSession("local[2]"), "y")
    with pytest.raises(ValueError):
        scratch_path(FakeSession("spark://host:7077"), "y")


def test_finished_work_leaves_nothing_staged(spark):
    from rowbridge.common import stage, staging

    with staging(spark):
        files = stage(spark.range(3), "short").inputFiles()
        assert files and all(Path(urlparse(f).path).exists() for f in files)
    assert not any(Path(urlparse(f).path).exists() for f in files)


def test_script_statements(spark):
    text = "select ';' as a; -- one; two\n/* x;y */ select \"b;\" as `c;`;;\n select /*+ broadcast(t) */ 1 as d from range(1) t"
    assert split_statements(text) == [
        "select ';' as a", 'select "b;" as `c;`', "select /*+ broadcast(t) */ 1 as d from range(1) t",
    ]
    assert run_script(spark, text).head().d == 1
    assert returns_rows("with a as (select 1) select * from a") and not returns_rows("drop table x")
    with pytest.raises(ValueError):
        run_script(spark, " -- nothing\n;")


@pytest.mark.parametrize("overwrite", ["static", "dynamic"])
def test_script_deletes_from_a_plain_table(spark, tmp_path, overwrite):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", overwrite)
    try:
        result = run_script(
            spark,
            f"""
            create table loose (id int, v string, p int) using parquet partitioned by (p) location '{tmp_path}/{overwrite}';
            insert into loose values (1, 'a;b', 1), (2, null, 1), (3, 'c', 2);
            delete from loose where v = 'c' or v is null;
            select id from loose
            """,
        )
        assert [r.id for r in result.collect()] == [1]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == overwrite
        run_script(spark, "delete from loose")
        assert spark.table("loose").count() == 0
        with pytest.raises(Exception):
            run_script(spark, "delete from nowhere")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql("drop table if exists loose")


def test_extract(spark, visitors):
    out = extract_table(visitors, ["id", "height + 1 as next"], "And badge like '%@gate.example' and id <> '{x}'", "entered desc")
    assert [tuple(r) for r in out.collect()] == [("5", 182), ("4", 176), ("3", 191), ("2", 173), ("1", 159)]
    assert clean_where(" and android_id = 1") == "android_id = 1"
    assert clean_where("android_id = 1") == "android_id = 1"
    assert declared_columns(["a", {"name": "b", "type": "long"}, {"type": "int"}]) == [("a", "STRING"), ("b", "LONG")]


def test_filter_and_columns_reach_the_scan(spark, visitors, tmp_path):
    visitors.write.parquet(str(tmp_path / "p"))
    out = extract_table(spark.read.parquet(str(tmp_path / "p")), ["id"], "height > 160")
    plan = executed(out)
    assert "PushedFilters: [IsNotNull(height), GreaterThan(height,160)]" in plan
    assert "ReadSchema: struct<id:string,height:int>" in plan


def test_catalog_scan(spark, visitors, tmp_path):
    spark.sql(f"create table people (id varchar(3), height int) using parquet location '{tmp_path}/people'")
    try:
        visitors.select("id", "height").write.insertInto("people")
        out = read_catalog_table(spark, "people", ["people.id", "height cm", "height * 2 twice"], "height > 175", "id")
        assert out.columns == ["id", "cm", "twice"]
        assert [tuple(r) for r in out.collect()] == [("3", 190, 380), ("5", 181, 362)]
        assert read_catalog_table(spark, "people", ["*"]).columns == ["id", "height"]
    finally:
        spark.sql("drop table if exists people")


def test_database_urls_and_options():
    connection = {"ip": "h", "port": "1", "database": "d", "username": "u", "password": "p", "jdbcUrlParam": {"a": "b"}}
    assert jdbc.jdbc_url("mysql", connection) == (
        "jdbc:mysql://h:1/d?rewriteBatchedStatements=true&useUnicode=true&characterEncoding=utf8"
        "&useCursorFetch=true&serverTimezone=GMT%2B8&a=b"
    )
    assert jdbc.jdbc_url("postgresql", {**connection, "schema": "s", "jdbcUrlParam": None}) == "jdbc:postgresql://h:1/d?currentSchema=s"
    hive = jdbc.jdbc_url("hive", {**connection, "database": "default", "authMechanism": "PLAIN", "jdbcUrlParam": {}})
    assert hive.startswith("jdbc:hive2://h:1/;user=u;password=p;useUnicode=true")
    odps = {"database": "d", "accessId": "i", "accessKey": "k", "odpsServer": "http://e"}
    assert jdbc.jdbc_url("odps", odps) == "jdbc:odps:d?accessId=i;accessKey=k;endpoint=http://e"
    options = jdbc.jdbc_options("mysql", connection, ["set a = 1;", "set b = 2"])
    assert options["fetchsize"] == "1000" and options["sessionInitStatement"] == "set a = 1; set b = 2"
    assert options["allowMultiQueries"] == "true" and "allowMultiQueries" not in jdbc.jdbc_options("mysql", connection, ["set a = 1"])
    assert jdbc.jdbc_options("odps", odps)["user"] == "i"
    with pytest.raises(ValueError):
        jdbc.jdbc_url("oracle", connection)


def test_database_relations():
    assert jdbc.relation("t", None, ["a", "b"], "and a > 1") == "(select a, b from t where a > 1) src"
    assert jdbc.relation("t", "select 1", None, None) == "(select * from (select 1) t) src"
    with pytest.raises(ValueError):
        jdbc.relation(None, " ", None, None)


def test_merge_statements():
    text = lambda kind, mode, keys=(): merge_statement(kind, "t", "s", ["a", "b"], mode, keys)
    assert text("mysql", "insert") == "insert into t (a, b) select a, b from s"
    assert text("mysql", "replace") == "replace into t (a, b) select a, b from s"
    assert text("mysql", "ignore") == "insert ignore into t (a, b) select a, b from s"
    assert text("mysql", "update").endswith("on duplicate key update a = values(a), b = values(b)")
    assert text("postgresql", "update", ["a"]).endswith("on conflict (a) do update set b = excluded.b")
    assert text("postgresql", "update", ["a", "b"]).endswith("on conflict (a, b) do nothing")
    assert text("postgresql", "ignore", ["a"]).endswith("on conflict (a) do nothing")
    for kind, mode in (("postgresql", "replace"), ("postgresql", "update"), ("odps", "update"), ("hbase", "ignore")):
        with pytest.raises(ValueError):
            check_write_mode(kind, mode)
