from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowbridge.common import session_setting
from rowbridge.functions.kinds import SPARK_TYPES
from rowbridge.operators import numbering, targets
from rowbridge.operators.report import export_stats
from rowbridge.sinks import chunks, columnar, delimited, partitions
from rowbridge.sources.delimited import read_delimited, read_lines


def contents(path, pattern="**/part-*"):
    return [p.read_text(encoding="utf-8") for p in sorted(Path(path).glob(pattern))]


def test_csv_matches_the_golden_file(three, tmp_path):
    delimited.export_csv(three.coalesce(1), str(tmp_path / "csv"))
    assert contents(tmp_path / "csv") == [
        "id,name,height,badge,entered\n"
        "1,Ødegård,158,north.17@gate.example,2031-06-11 08:15:30\n"
        "2,Šárka,172,east.4@gate.example,2031-06-11 09:40:00\n"
        "3,Ng Wei,190,north.3@gate.example,2031-06-12 17:05:45\n"
    ]


def test_cells_are_cleaned_but_never_quoted(spark, tmp_path):
    df = spark.createDataFrame([('#a "q"', "x\ny,z", None, 1e10)], "a string, b string, c string, d double")
    df = df.coalesce(1)
    delimited.export_csv(df, str(tmp_path / "csv"), "tab")
    assert contents(tmp_path / "csv") == ['a\tb\tc\td\n#a "q"\tx y z\t\t1.0E10\n']
    delimited.write_delimited(df, str(tmp_path / "txt"), "pipe")
    assert contents(tmp_path / "txt") == ['#a "q"|x y z||10000000000\n']


def test_every_file_has_one_header(spark, tmp_path):
    df = spark.range(0, 100, 1, 7).withColumn("v", F.lit("x"))
    assert delimited.export_csv(df, str(tmp_path / "csv")) == 100
    files = contents(tmp_path / "csv")
    assert len(files) == 7 and all(f.startswith("id,v\n") and f.count("id,v") == 1 for f in files)
    back = read_delimited(spark, str(tmp_path / "csv"), ["id", "v"], skip_header=True)
    assert sorted(int(r.id) for r in back.collect()) == list(range(100))


def test_empty_table_leaves_the_header(three, tmp_path):
    assert delimited.export_csv(three.where("id = 'none'"), str(tmp_path / "csv")) == 0
    assert "".join(contents(tmp_path / "csv")) == "id,name,height,badge,entered\n"
    assert delimited.export_csv(three.limit(0), str(tmp_path / "csv2")) == 0


def test_session_record_limit_does_not_cut_headers(spark, three, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 1)
    try:
        delimited.export_csv(three.coalesce(1), str(tmp_path / "csv"))
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", 0)
    assert len(contents(tmp_path / "csv")) == 1


def test_reading_keeps_cells_as_they_are(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes('id|v\r\n1| "a\\\n\n  \n2\n#3|b|c\n'.encode())
    (tmp_path / "b.txt").write_bytes(b"id|v\nid|v")
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]
    rows = sorted(tuple(r) for r in read_delimited(spark, paths, ["id", "v"], "|", True).fillna("<null>").collect())
    assert rows == [("#3", "b"), ("1", ' "a\\'), ("2", "<null>"), ("id", "v")]
    assert read_delimited(spark, paths, ["id", "v"], "pipe").count() == 6
    (tmp_path / "blank.txt").write_text("\t \u3000\na\n\n", encoding="utf-8")
    assert read_lines(spark, str(tmp_path / "blank.txt")).count() == 1
    with pytest.raises(ValueError):
        read_lines(spark, [])


def test_header_of_a_file_read_in_pieces(spark, tmp_path):
    (tmp_path / "big.txt").write_text("h\n" + "".join(f"row {i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20000)
    try:
        lines = read_lines(spark, str(tmp_path / "big.txt"), skip_header=True)
        assert lines.rdd.getNumPartitions() > 3
        assert lines.count() == 20000 and lines.where("value = 'h'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")


def test_json_omits_nulls(spark, tmp_path):
    df = spark.sql("select 1 a, cast(null as string) b, timestamp_ntz '2024-01-02 03:04:05.678' c")
    columnar.export_json(df, str(tmp_path / "json"))
    assert contents(tmp_path / "json") == ['{"a":1,"c":"2024-01-02 03:04:05"}\n']


def test_parquet_and_orc_types(spark, tmp_path):
    df = spark.sql(
        "select 1 i, cast(null as bigint) l, cast(null as double) d, true b, date '1970-01-02' t,"
        " cast(null as string) s"
    )
    columnar.export_parquet(df, str(tmp_path / "p"))
    assert dict(spark.read.parquet(str(tmp_path / "p")).dtypes)["t"] == "string"
    columnar.export_orc(df, str(tmp_path / "o"), legacy_nulls=True)
    row = spark.read.orc(str(tmp_path / "o")).head()
    assert (row.i, row.l, str(row.d), row.b, row.t, row.s) == (1, 0, "nan", 1, 86400000, "")
    columnar.export_orc(df, str(tmp_path / "o2"), compression="SNAPPY")
    assert spark.read.orc(str(tmp_path / "o2")).head().l is None


def test_row_chunks_match_the_golden_files(visitors, tmp_path):
    chunks.export_row_chunks(visitors, str(tmp_path / "c"), 2, order_by=["id"])
    got = [contents(tmp_path / "c", f"chunk_id={i}/part-*") for i in range(3)]
    assert got == [
        [
            "id,name,height,badge,entered\n1,Ødegård,158,north.17@gate.example,2031-06-11 08:15:30\n"
            "2,Šárka,172,east.4@gate.example,2031-06-11 09:40:00\n"
        ],
        [
            "id,name,height,badge,entered\n3,Ng Wei,190,north.3@gate.example,2031-06-12 17:05:45\n"
            "4,Łucja,175,west.88@gate.example,2031-06-13 10:00:10\n"
        ],
        ["id,name,height,badge,entered\n5,José,181,east.5@gate.example,2031-06-15 23:59:59\n"],
    ]
    assert not (tmp_path / "c" / "chunk_id=3").exists()


def test_row_numbers_are_exact(spark):
    # A third of the rows share one sort key.
    df = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, 5, id) as k", "id as v")
    numbered = numbering.number_rows(df, ["k"])
    rows = numbered.orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(9000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    assert sorted(r.v for r in rows) == list(range(9000))
    assert [tuple(r) for r in numbered.orderBy("row_id").collect()] == [tuple(r) for r in rows]
    sizes = numbering.row_chunks(df, 4000, ["k"]).groupBy("chunk_id").count().orderBy("chunk_id").collect()
    assert [r["count"] for r in sizes] == [4000, 4000, 1000]


def test_hot_sort_key_is_spread(spark):
    from rowbridge.common import row_hash

    df = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, 5, id) as k", "id as v")
    ordered = df.orderBy("k", row_hash(df))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = ordered.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in parts) < 3000


def test_numbering_without_order_keeps_all_rows(spark):
    df = spark.range(0, 1000, 1, 5)
    rows = numbering.number_rows(df).collect()
    assert sorted(r.row_id for r in rows) == list(range(1000))
    with pytest.raises(ValueError):
        numbering.row_chunks(df, 0)


def test_column_chunks(visitors, tmp_path):
    index = chunks.export_column_chunks(visitors.select("id", "name"), str(tmp_path / "c"), 2, order_by=["id"])
    assert index == {"id": "1", "name": "2"}
    assert contents(tmp_path / "c", "col_idx=0000000002/chunk_id=1/part-*") == ["name\nNg Wei\nŁucja\n"]
    assert contents(tmp_path / "c", "col_idx=0000000001/chunk_id=2/part-*") == ["id\n5\n"]
    assert [json.loads(t) for t in contents(tmp_path / "c", "_indexMap.json/part-*")] == [index]


def test_column_chunks_follow_typed_order(spark, tmp_path):
    df = spark.range(0, 12, 1, 3).selectExpr("id", "id * 0.5 as half")
    chunks.export_column_chunks(df, str(tmp_path / "c"), 7, header=False, order_by=["id"])
    first = contents(tmp_path / "c", "col_idx=0000000001/chunk_id=0/part-*")
    assert first == ["".join(f"{i}\n" for i in range(7))]
    second = contents(tmp_path / "c", "col_idx=0000000002/chunk_id=1/part-*")
    assert second == ["".join(f"{i * 0.5}\n" for i in range(7, 12))]


def test_typed_column_chunks(spark, visitors, tmp_path):
    chunks.export_column_chunks(visitors.select("id", "height"), str(tmp_path / "c"), 2, "parquet", order_by=["id"])
    heights = spark.read.parquet(str(tmp_path / "c" / "col_idx=0000000002"))
    assert dict(heights.dtypes)["height"] == "int"
    assert [tuple(r) for r in heights.orderBy("chunk_id", "height").collect()] == [(158, 0), (172, 0), (175, 1), (190, 1), (181, 2)]


def test_typed_column_chunks_shuffle_once(spark, tmp_path):
    """A column's plan reads buckets without an exchange, a chunk is one file in the order of its rows."""
    df = spark.range(0, 3000, 1, 4).selectExpr("(id * 7919) % 3000 as id", "cast(id as double) / 4 as d", "repeat('x', 200) as t")
    plans = []
    taken = chunks.typed_column

    def watched(bucketed, name):
        cells = taken(bucketed, name)
        plans.append(cells._jdf.queryExecution().executedPlan().toString())
        return cells

    chunks.typed_column = watched
    try:
        with session_setting(spark, "spark.sql.files.maxPartitionBytes", "2k"):
            chunks.export_column_chunks(df, str(tmp_path / "c"), 250, "orc", order_by=["id"])
    finally:
        chunks.typed_column = taken
    assert len(plans) == 3 and all("Exchange" not in p and "Bucketed: true" in p for p in plans)
    for i in range(12):
        files = list((tmp_path / "c" / "col_idx=0000000001" / f"chunk_id={i}").glob("part-*"))
        assert len(files) == 1
        assert [r.id for r in spark.read.orc(str(files[0])).collect()] == list(range(i * 250, i * 250 + 250))
    halves = spark.read.orc(str(tmp_path / "c" / "col_idx=0000000002"))
    assert dict(halves.dtypes)["d"] == "double" and halves.count() == 3000
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("rowbridge_columns")]


def test_sizes_and_partitions():
    assert [partitions.parse_size(s) for s in ("8MB", "1gb", " 64KB ", "100")] == [8 << 20, 1 << 30, 64 << 10, 100]
    assert partitions.parse_partition("dt='2025,07',hour=01") == {"dt": "2025,07", "hour": "01"}
    for bad in ("8 miles", ""):
        with pytest.raises(ValueError):
            partitions.parse_size(bad)
    with pytest.raises(ValueError):
        partitions.parse_partition("nothing")


def test_files_roll_by_size(spark, tmp_path):
    df = spark.range(0, 2000, 1, 1).withColumn("text", F.repeat(F.lit("x"), 100))
    limit = partitions.roll_files_by_size(df, str(tmp_path / "r"), "50KB", "json")
    files = [p.stat().st_size for p in (tmp_path / "r").glob("part-*")]
    assert 300 < limit < 600 and len(files) == -(-2000 // limit) and max(files) < 80_000


def test_load_partition_replaces_only_its_partition(spark, tmp_path):
    df = spark.range(4).withColumn("v", F.lit("a"))
    place = str(tmp_path / "t")
    try:
        for mode, part in (("insert", "1"), ("insert", "1"), ("overwrite", "2"), ("overwrite", "2")):
            partitions.load_partition(df, "loads", {"p": part}, mode, "parquet", location=place)
        counts = {r.p: r["count"] for r in spark.table("loads").groupBy("p").count().collect()}
        assert counts == {"1": 8, "2": 4}
        partitions.load_partition(df, "loads", {"p": "{it's}\\"}, "insert")
        assert spark.table("loads").where(F.col("p") == "{it's}\\").count() == 4
        partitions.rewrite_table(spark, "loads", partitions.delete_where(spark.table("loads"), "id > 0"))
        assert spark.table("loads").count() == 4
        with pytest.raises(ValueError):
            partitions.load_partition(df, "loads", {"p": "1"}, "update")
    finally:
        spark.sql("drop table if exists loads")


def test_text_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, "c")], "id int, v string").coalesce(1)
    try:
        partitions.load_partition(df.where("id = 2"), "text_loads", file_type="text", sep="|", location=str(tmp_path / "t"))
        assert contents(tmp_path / "t") == ["2|c\n"]
        assert [tuple(r) for r in spark.table("text_loads").collect()] == [(2, "c")]
    finally:
        spark.sql("drop table if exists text_loads")


def test_targets(spark):
    df = spark.createDataFrame([("12.9", "long text", "null", '""')], "a string, b string, c string, d string")
    schema = "x bigint, y string, z string, w string"
    from pyspark.sql.types import StructType

    bound = targets.bind_to_target(df, StructType.fromDDL(schema), {"y": 4, "z": 0})
    assert tuple(bound.head()) == (12, "long", "null", '""')
    assert tuple(targets.null_tokens(df).head()) == ("12.9", "long text", None, None)
    assert set(SPARK_TYPES) == {"STRING", "LONG", "INT", "DOUBLE", "BOOL", "DATE", "BYTES"}


def test_export_stats(spark, tmp_path):
    spark.range(0, 10, 1, 3).write.parquet(str(tmp_path / "p"))
    row = export_stats(spark.read.parquet(str(tmp_path / "p"))).head()
    assert (row.files, row.columns, row.rows) == (3, 1, 10)
