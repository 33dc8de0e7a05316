"""Whole jobs in the JSON shape, over the person table and its relatives."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowbridge.plans import job as job_module
from rowbridge.plans.job import Job, load_job, run_job, substitute

COLUMNS = ["id", "name", "height", "badge", "entered"]


def texts(path):
    found = [p.read_text(encoding="utf-8") for p in sorted(Path(path).glob("**/part-*"))]
    return sorted(line for text in found for line in text.splitlines())


def move(reader, writer, steps=(), **setting):
    return {
        "job": {
            "sqlMode": 2,
            "setting": {"speed": {"channel": 2}, **setting},
            "content": [{"reader": reader, "writer": writer, "transformer": list(steps)}],
        }
    }


def common(mode, parameter, **setting):
    return {
        "job": {
            "sqlMode": mode,
            "setting": {"speed": {"channel": 1}, **setting},
            "content": [{"common": {"name": "Mysql", "parameter": parameter}}],
        }
    }


def mysql(table="visitors", **more):
    return {"name": "Mysql", "parameter": {"table": table, "column": COLUMNS, **more}}


def text_sink(path, **more):
    return {"name": "TxtFile", "parameter": {"filePath": str(path), "sep": ",", **more}}


@pytest.mark.parametrize("kind", ["csv", "json", "parquet", "orc"])
def test_export(spark, three, tmp_path, kind):
    parameter = {
        "table": "visitors", "column": COLUMNS, "where": "and height > 158", "orderby": "height desc",
        "saveUrl": str(tmp_path / "out"), "fileType": kind,
    }
    report = run_job(spark, common(0, parameter, reportPath=str(tmp_path / "r" / "report.json")), {"visitors": three})
    assert report["code"] == 0
    assert report["data"]["tableColNum"] == 5 and report["data"]["tableRowNum"] == 2
    assert json.loads((tmp_path / "r" / "report.json").read_text())["commonName"] == "Mysql"


def test_export_query_with_chunks(spark, visitors, tmp_path):
    parameter = {
        "querySql": "select id, upper(badge) as badge from visitors", "column": ["badge"], "where": "id > '1'",
        "orderby": "id", "saveUrl": str(tmp_path / "q"), "chunkSize": 3,
    }
    report = run_job(spark, common(0, parameter), {"visitors": visitors})
    assert report["data"] == {"colFileNum": 2, "tableColNum": 1, "tableRowNum": 4, "path": f"{tmp_path}/q/result"}
    assert texts(tmp_path / "q").count("badge") == 2


def test_export_by_column(spark, visitors, tmp_path):
    parameter = {
        "table": "visitors", "column": COLUMNS, "saveUrl": str(tmp_path / "c"), "isChunk": True, "chunkSize": 2,
    }
    report = run_job(spark, common(0, parameter), {"visitors": visitors})
    assert report["data"]["colFileNum"] == 15
    assert len(list((tmp_path / "c" / "visitors").glob("col_idx=*"))) == 5


def test_script_job(spark, tmp_path):
    script = tmp_path / "script.sql"
    script.write_text(
        "create or replace temp view s as select * from values (1, 'a;b'), (2, 'c') t(id, v); -- two; rows\n"
        "select * from s;\nselect v, id from s order by id desc;\n",
        encoding="utf-8",
    )
    out = tmp_path / "result"
    report = run_job(spark, common(1, {"sqlFile": str(script), "sql": "select 1", "saveUrl": str(out)}))
    assert report["data"]["tableRowNum"] == 2
    assert "".join(p.read_text() for p in sorted(out.glob("result/part-*"))).replace("v,id\n", "") == "c,2\na;b,1\n"
    assert run_job(spark, common(1, {"sql": "create or replace temp view s as select 1"}))["data"] == {}
    for bad in ({"sql": "  "}, {"sql": "SELEC * FROM s"}):
        with pytest.raises(Exception):
            run_job(spark, common(1, bad))


def test_move_to_text(spark, three, tmp_path):
    report = run_job(spark, move(mysql(), text_sink(tmp_path / "t", sep="\\t")), {"visitors": three})
    assert report["data"] == {"read": 3, "written": 3, "matched": True}
    assert texts(tmp_path / "t")[0] == "1\tØdegård\t158\tnorth.17@gate.example\t2031-06-11 08:15:30"


def test_multiple_transformers(spark, three, tmp_path):
    padded = three.withColumn("name", F.concat(F.lit(" \t"), "name", F.lit(" ")))
    steps = [
        {"name": "trim", "parameter": {"columnIndex": [1]}},
        {"name": "replace", "parameter": {"columnIndex": [1], "oldValue": "Ødegård", "newValue": "Solveig"}},
        {"name": "filter", "parameter": {"columnIndex": [2], "value": "160", "op": ">"}},
    ]
    report = run_job(spark, move(mysql(), text_sink(tmp_path / "m"), steps), {"visitors": padded})
    assert report["data"]["read"] == 2
    assert texts(tmp_path / "m") == [
        "2,Šárka,172,east.4@gate.example,2031-06-11 09:40:00", "3,Ng Wei,190,north.3@gate.example,2031-06-12 17:05:45",
    ]


def test_flags(spark, tmp_path):
    flags = spark.createDataFrame([("1", "Ødegård", 1), ("2", "Šárka", 0), ("3", "Ng Wei", 1)], "id string, name string, flag int")
    reader = {"name": "Mysql", "parameter": {"table": "flags", "column": ["id", "name", "flag"]}}
    sink = text_sink(tmp_path / "b", skipHeader=False, column=["id", "name", "flag"])
    step = {"name": "zeroonetoboolean", "parameter": {"columnIndex": [2]}}
    run_job(spark, move(reader, sink, [step]), {"flags": flags})
    lines = texts(tmp_path / "b")
    assert {"id,name,flag", "1,Ødegård,true", "2,Šárka,false", "3,Ng Wei,true"} == set(lines)


def test_empty_table(spark, three, tmp_path):
    sink = text_sink(tmp_path / "e", skipHeader=False, column=COLUMNS)
    report = run_job(spark, move(mysql(), sink), {"visitors": three.where("height > 999")})
    assert report["data"] == {"read": 0, "written": 0, "matched": True}
    assert texts(tmp_path / "e") == [",".join(COLUMNS)]


def test_text_chunks(spark, visitors, tmp_path):
    run_job(spark, move(mysql(), text_sink(tmp_path / "c", chunkSize=2)), {"visitors": visitors})
    sizes = sorted(len(p.read_text().splitlines()) for p in (tmp_path / "c").glob("chunk_id=*/part-*"))
    assert sizes == [1, 2, 2]


def test_text_to_partitioned_table(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,a,1.5,true,2025-01-02 03:04:05\n2,b,,FALSE,2025-01-02\n", encoding="utf-8")
    kinds = [("id", "LONG"), ("name", "STRING"), ("score", "DOUBLE"), ("flag", "BOOL"), ("created_at", "DATE")]
    typed = [{"name": n, "type": k} for n, k in kinds]
    reader = {"name": "TxtFile", "parameter": {"filePath": [str(tmp_path / "in.csv")], "column": typed}}
    null_empty = {"name": "nullempty", "parameter": {}}
    from rowbridge.operators.targets import null_tokens
    from rowbridge.operators.transforms import register

    register("nullempty", lambda df, p: null_tokens(df))
    writer = {
        "name": "Hive",
        "parameter": {
            "table": "job_loaded", "column": typed, "partition": "dt='20250719'", "compress": "SNAPPY",
            "maxFileSize": "8MB", "writeMode": "overwrite", "location": str(tmp_path / "table"),
        },
    }
    try:
        for _ in range(2):
            assert run_job(spark, move(reader, writer, [null_empty]))["data"]["matched"]
        table = spark.table("job_loaded")
        assert [t for _, t in table.dtypes] == ["bigint", "string", "double", "boolean", "timestamp", "string"]
        rows = table.orderBy("id").collect()
        assert [(r.id, r.score, r.flag, r.dt) for r in rows] == [(1, 1.5, True, "20250719"), (2, None, False, "20250719")]
        back = {"name": "Hive", "parameter": {"table": "job_loaded", "column": ["id n", "score"], "where": "dt = '20250719'"}}
        run_job(spark, move(back, text_sink(tmp_path / "back")))
        assert texts(tmp_path / "back") == ["1,1.5", "2,"]
    finally:
        spark.sql("drop table if exists job_loaded")


def test_cells_to_text(spark, three, tmp_path):
    columns = [{"name": f"cf1:{c}", "type": "int" if c == "height" else "string"} for c in COLUMNS]
    cells = {"name": "HBase", "parameter": {"table": "ns:cells", "rowkey": "id", "column": columns}}
    empty = spark.createDataFrame([], "rowkey string, family string, qualifier string, value binary, version bigint")
    job = Job(spark, move(mysql(), cells), {"visitors": three, "ns:cells": empty})
    assert job.run()["data"]["matched"]
    ranged = {**cells["parameter"], "splitMode": "range", "range": {"startRowkey": "1", "endRowkey": "3"}}
    run_job(spark, move({"name": "HBase", "parameter": ranged}, text_sink(tmp_path / "c")), job.tables)
    assert texts(tmp_path / "c") == [
        "1,Ødegård,158,north.17@gate.example,2031-06-11 08:15:30", "2,Šárka,172,east.4@gate.example,2031-06-11 09:40:00",
    ]
    with pytest.raises(ValueError):
        run_job(spark, move(mysql(), {**cells, "parameter": {**cells["parameter"], "writeMode": "update"}}), job.tables)


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("insert", None),
        ("ignore", [("1", "Ødegård", 158), ("2", "Šárka", 172), ("9", "old", 9)]),
        ("update", [("1", "Ødegård", 158), ("2", "Šárka", 172), ("9", "old", 9)]),
        ("overwrite", [("1", "Ødegård", 158), ("2", "Šárka", 172)]),
    ],
)
def test_write_modes(spark, three, mode, expected):
    target = spark.createDataFrame([("1", "Ødegård", 158), ("9", "old", 9)], "id string, name string, height int")
    writer = {
        "name": "Mysql",
        "parameter": {"table": "sink", "column": ["id", "name", "height"], "writeMode": mode, "primaryKey": ["id"]},
    }
    reader = {"name": "Mysql", "parameter": {"table": "visitors", "column": ["id", "name", "height"], "where": "id < '3'"}}
    job = Job(spark, move(reader, writer), {"visitors": three, "sink": target})
    if expected is None:
        with pytest.raises(ValueError):
            job.run()
        return
    assert job.run()["data"] == {"read": 2, "written": 2, "matched": True}
    assert sorted(tuple(r) for r in job.tables["sink"].collect()) == expected


def test_failures_are_reported(spark, three, tmp_path):
    report = tmp_path / "report.json"
    bad = [
        move({"name": "MysqlNotExist", "parameter": {"table": "t"}}, text_sink(tmp_path / "x"), reportPath=str(report)),
        move(mysql(), {"name": "Nowhere", "parameter": {"table": "t"}}, reportPath=str(report)),
        common(0, {"table": "visitors", "column": COLUMNS, "saveUrl": str(tmp_path / "y"), "fileType": "xls"}, reportPath=str(report)),
        common(0, {"table": "visitors", "column": COLUMNS, "saveUrl": "/proc/no/such/place"}, reportPath=str(report)),
        common(0, {"table": "visitors", "column": ["missing"], "saveUrl": str(tmp_path / "z")}, reportPath=str(report)),
        {"job": {"sqlMode": 7, "setting": {"reportPath": str(report)}, "content": [{}]}},
    ]
    for job in bad:
        report.write_text("{}")
        with pytest.raises(Exception):
            run_job(spark, job, {"visitors": three})
        written = json.loads(report.read_text(encoding="utf-8"))
        assert written["code"] == 1 and written["stackTrace"]


def test_statements_before_and_after(spark, three, tmp_path):
    reader = mysql(preSql=["create or replace temp view before_job as select 1 as x"])
    writer = {"name": "Nowhere", "parameter": {"table": "t", "postSql": ["create or replace temp view after_job as select 2 as x"]}}
    with pytest.raises(ValueError):
        run_job(spark, move(reader, writer), {"visitors": three})
    assert spark.table("before_job").head().x == 1 and spark.table("after_job").head().x == 2


def test_variables(tmp_path):
    (tmp_path / "job.json").write_text('{"job": {"sqlMode": 0, "p": "${dir}/$name/${none}"}}')
    assert load_job(str(tmp_path / "job.json"), {"dir": "/data", "name": "x"})["job"]["p"] == "/data/x/${none}"
    assert substitute("$a${b}", {"a": " ", "b": "2"}) == "$a2"


@pytest.mark.parametrize("mode, kept", [("ignore", "first"), ("update", "third"), ("replace", "third")])
def test_write_order_decides_repeated_keys(spark, mode, kept):
    source = spark.createDataFrame([(1, "second", 2), (1, "third", 3), (1, "first", 1)], "id int, name string, seq int")
    target = spark.createDataFrame([(9, "old")], "id int, name string")
    reader = {"name": "Mysql", "parameter": {"table": "source", "column": ["id", "name", "seq"]}}
    sink = {"table": "sink", "column": ["id", "name"], "writeMode": mode, "primaryKey": ["id"]}
    job = lambda **more: Job(spark, move(reader, {"name": "Mysql", "parameter": {**sink, **more}}), {"source": source, "sink": target})
    ordered = job(orderBy="seq")
    assert ordered.run()["data"] == {"read": 3, "written": 3, "matched": True}
    assert sorted(tuple(r) for r in ordered.tables["sink"].collect()) == [(1, kept), (9, "old")]
    with pytest.raises(ValueError, match="orderBy"):
        job().run()
    with pytest.raises(ValueError, match="primaryKey"):
        job(primaryKey=[]).run()


def test_scripts_of_other_databases_are_refused(spark):
    script = {"job": {"sqlMode": 1, "content": [{"common": {"name": "Mysql", "parameter": {"sql": "select 1", "connection": {"ip": "h"}}}}]}}
    with pytest.raises(ValueError, match="Spark SQL"):
        run_job(spark, script)


def test_update_in_scripts(spark):
    from rowbridge.plans.script import parse_assignments, run_script

    assert parse_assignments("a = concat(b, ',x'), t.`c` = case when d = 1 then 2 else 3 end where e in (1, 2)") == (
        {"a": "concat(b, ',x')", "c": "case when d = 1 then 2 else 3 end"}, "e in (1, 2)"
    )
    try:
        found = run_script(spark, """
            create table upd using parquet as select id, cast(id as string) as name from range(4);
            update upd set NAME = concat(name, ', where'), id = id + 10 where id > 1;
            select * from upd order by id
        """)
        assert [tuple(r) for r in found.collect()] == [(0, "0"), (1, "1"), (12, "2, where"), (13, "3, where")]
    finally:
        spark.sql("drop table if exists upd")


@pytest.mark.parametrize("kind,extra", [("csv", {}), ("csv", {"chunkSize": 3}), ("txt", {"skipHeader": False, "column": ["n", "t"]}), ("json", {}), ("parquet", {"chunkSize": 2}), ("orc", {})])
def test_a_row_lost_in_the_sink_shows(spark, tmp_path, monkeypatch, kind, extra):
    """Text sinks are counted by their files, so what the writer drops is missed."""
    rows = spark.range(7).selectExpr("id as n", "concat('line', chr(10), id) as t")
    reader = {"name": "Mysql", "parameter": {"table": "given"}}
    writer = text_sink(tmp_path / "whole", fileType=kind, **extra)
    assert run_job(spark, move(reader, writer), {"given": rows})["data"] == {"read": 7, "written": 7, "matched": True}
    for name in ("export_row_chunks", "write_delimited", "export_json", "export_parquet", "export_orc"):
        whole = getattr(job_module, name)
        monkeypatch.setattr(job_module, name, lambda df, *a, whole=whole, **k: whole(df.where("n <> 5"), *a, **k))
    writer = text_sink(tmp_path / "less", fileType=kind, **extra)
    data = run_job(spark, move(reader, writer), {"given": rows})["data"]
    assert data == {"read": 7, "written": 6, "matched": False}


def _catalog_job(spark, mode, **more):
    reader = {"name": "Mysql", "parameter": {"table": "deliveries", "column": ["id", "label", "day", "seq"]}}
    writer = {"name": "Hive", "parameter": {"table": "depot", "column": ["id", "label", "day"], "writeMode": mode, **more}}
    return move(reader, writer)


@pytest.mark.parametrize("mode", ["ignore", "update", "replace"])
def test_merge_into_a_catalog_table(spark, tmp_path, mode, monkeypatch):
    rows = spark.createDataFrame(
        [(1, "b", "mon", 2), (1, "a", "mon", 1), (7, "c", "tue", 1)], "id int, label string, day string, seq int"
    )
    spark.sql(f"create table depot (id int, label string, day string) using parquet partitioned by (day) location '{tmp_path}/depot'")
    try:
        spark.sql("insert into depot select * from values (1, 'old', 'mon'), (2, 'two', 'wed')")
        untouched = [p.name for p in (tmp_path / "depot" / "day=wed").glob("part-*")]
        with pytest.raises(ValueError, match="orderBy"):
            run_job(spark, _catalog_job(spark, mode, primaryKey=["id"]), {"deliveries": rows})
        with pytest.raises(ValueError, match="primaryKey"):
            run_job(spark, _catalog_job(spark, mode), {"deliveries": rows})
        job = _catalog_job(spark, mode, primaryKey=["id"], orderBy="seq")
        assert run_job(spark, job, {"deliveries": rows})["data"] == {"read": 3, "written": 3, "matched": True}
        first = "old" if mode == "ignore" else "b"
        assert sorted(tuple(r) for r in spark.table("depot").collect()) == [(1, first, "mon"), (2, "two", "wed"), (7, "c", "tue")]
        assert [p.name for p in (tmp_path / "depot" / "day=wed").glob("part-*")] == untouched
        whole = job_module.merge_table

        def lossy(table, *rest):
            whole(table, *rest)
            spark.sql("insert overwrite depot select * from values (7, 'c', 'tue'), (2, 'two', 'wed')")

        monkeypatch.setattr(job_module, "merge_table", lossy)
        assert run_job(spark, job, {"deliveries": rows})["data"] == {"read": 3, "written": 1, "matched": False}
    finally:
        spark.sql("drop table if exists depot")


@pytest.mark.parametrize("mode", ["insert", "ignore", "update", "replace"])
@pytest.mark.parametrize("keys", [["id"], []])
def test_a_row_lost_in_a_merge_shows(spark, monkeypatch, mode, keys):
    if mode != "insert" and not keys:
        pytest.skip("this mode needs keys")
    source = spark.range(5).selectExpr("cast(id as int) as id", "'new' as label")
    target = spark.createDataFrame([(100, "x")], "id int, label string")
    reader = {"name": "Mysql", "parameter": {"table": "source", "column": ["id", "label"]}}
    writer = {"name": "Mysql", "parameter": {"table": "sink", "column": ["id", "label"], "writeMode": mode, "primaryKey": keys}}
    run = lambda: run_job(spark, move(reader, writer), {"source": source, "sink": target})["data"]
    assert run() == {"read": 5, "written": 5, "matched": True}
    lossy = lambda whole: lambda *a, **k: whole(*a, **k).where("id <> 3")
    monkeypatch.setattr(job_module, "merge_insert", lossy(job_module.merge_insert))
    monkeypatch.setattr(job_module, "MERGES", {m: lossy(f) for m, f in job_module.MERGES.items()})
    assert run() == {"read": 5, "written": 4, "matched": False}


@pytest.mark.parametrize("mode", ["insert", "overwrite"])
def test_a_row_lost_in_a_load_shows(spark, tmp_path, monkeypatch, mode):
    rows = spark.createDataFrame([(i, "x", "d", i) for i in range(6)], "id int, label string, day string, seq int")
    job = _catalog_job(spark, mode, partition="part='1'", location=str(tmp_path / "t"))
    try:
        for _ in range(2):
            assert run_job(spark, job, {"deliveries": rows})["data"] == {"read": 6, "written": 6, "matched": True}
        whole = job_module.load_partition
        monkeypatch.setattr(job_module, "load_partition", lambda df, *rest: whole(df.where("id <> 2"), *rest))
        assert run_job(spark, job, {"deliveries": rows})["data"] == {"read": 6, "written": 5, "matched": False}
    finally:
        spark.sql("drop table if exists depot")


def test_cells_keep_the_last_write(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("k", "zz", 1), ("k", "aa", 2), ("k", None, 3), ("l", "b", 1)], "id string, label string, seq int"
    )
    reader = {"name": "Mysql", "parameter": {"table": "given", "column": ["id", "label", "seq"]}}
    columns = [{"name": f"cf:{c}", "type": "string"} for c in ("id", "label")]
    parameter = {"table": "cells", "rowkey": "id", "column": columns, "orderBy": "seq"}
    empty = spark.createDataFrame([], "rowkey string, family string, qualifier string, value binary, version bigint")
    job = Job(spark, move(reader, {"name": "HBase", "parameter": parameter}), {"given": rows, "cells": empty})
    assert job.run()["data"] == {"read": 4, "written": 2, "matched": False}
    found = job.tables["cells"].selectExpr("rowkey", "qualifier", "cast(value as string) as v").collect()
    assert sorted(tuple(r) for r in found) == [("k", "label", "aa"), ("l", "label", "b")]
    whole = job_module.rows_to_cells
    monkeypatch.setattr(job_module, "rows_to_cells", lambda df, *a, **k: whole(df.where("id <> 'l'"), *a, **k))
    assert job.run()["data"]["written"] == 1
    parameter["orderBy"] = "label"
    with pytest.raises(ValueError, match="order writes"):
        job.run()
