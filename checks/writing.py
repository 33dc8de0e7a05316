"""Merges, exports, partition loads and reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import collector, table
from rowbridge.common import scratch_path
from rowbridge.operators import merges
from rowbridge.operators.numbering import column_chunks as unpivot_columns
from rowbridge.operators.numbering import number_rows
from rowbridge.operators.numbering import row_chunks as cut_rows
from rowbridge.operators.report import RowCounter
from rowbridge.operators.report import export_stats as count_export
from rowbridge.operators.transforms import apply_chain
from rowbridge.sinks import columnar, partitions
from rowbridge.sinks.chunks import export_column_chunks as write_column_chunks
from rowbridge.sinks.chunks import export_row_chunks as write_row_chunks
from rowbridge.sinks.delimited import export_csv as write_csv
from rowbridge.plans.job import Job
from rowbridge.sinks.delimited import write_delimited as write_text
from rowbridge.sinks.touched import merge_table
from rowbridge.sources.delimited import read_delimited

CHECKS: dict = {}
check = collector(CHECKS)

# The target is the customers; the source is one row per order under twice its
# customer's key, so keys repeat and about half of them are new.
_TARGET = "t as (select c_custkey, c_name, c_mktsegment, c_acctbal from customer)"
_SOURCE = """
    s0 as (select o_custkey * 2 as c_custkey, 'order ' || o_orderkey as c_name,
                  case when o_orderkey % 4 <> 0 then o_totalprice end as c_acctbal, o_orderkey as seq
           from orders)
"""


def _pick(order):
    return f"""
    s as (select * exclude (rn) from (select *, row_number() over
          (partition by c_custkey order by seq {order}) as rn from s0) where rn = 1)
    """


def _target(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def _source(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_custkey * 2 as c_custkey",
        "concat('order ', o_orderkey) as c_name",
        "case when o_orderkey % 4 <> 0 then o_totalprice end as c_acctbal",
        "o_orderkey as seq",
    )


@check(
    """
    select c_custkey, c_name, c_mktsegment from customer
    union all select -s_suppkey - 1, s_name, null from supplier
    """
)
def merge_insert(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    source = table(spark, sf, "supplier").selectExpr("-s_suppkey - 1 as c_custkey", "s_name as c_name")
    return merges.merge_insert(target, source, ["c_custkey"])


@check(
    f"""
    with {_TARGET}, {_SOURCE}, {_pick("asc")}
    select * from t union all
    select c_custkey, c_name, null, c_acctbal from s where c_custkey not in (select c_custkey from t)
    """
)
def merge_ignore(spark, sf):
    return merges.merge_ignore(_target(spark, sf), _source(spark, sf), ["c_custkey"], "seq")


_UPDATE_SQL = f"""
    with {_TARGET}, {_SOURCE}, {_pick("desc")}
    select coalesce(t.c_custkey, s.c_custkey) as c_custkey,
           case when s.c_custkey is not null then s.c_name else t.c_name end as c_name, t.c_mktsegment,
           case when s.c_custkey is not null then s.c_acctbal else t.c_acctbal end as c_acctbal
    from t full join s on t.c_custkey = s.c_custkey
"""


@check(_UPDATE_SQL)
def merge_update(spark, sf):
    return merges.merge_update(_target(spark, sf), _source(spark, sf), ["c_custkey"], "seq")


@check(_UPDATE_SQL)
def merge_update_large_source(spark, sf):
    """The joins as they run for a source beyond the broadcast threshold: both sides shuffled."""
    return merges.merge_update(_target(spark, sf).hint("merge"), _source(spark, sf), ["c_custkey"], "seq")


@check(
    f"""
    with {_TARGET}, {_SOURCE}, {_pick("desc")}
    select * from t where c_custkey not in (select c_custkey from s) union all
    select c_custkey, c_name, null, c_acctbal from s
    """
)
def merge_replace(spark, sf):
    return merges.merge_replace(_target(spark, sf), _source(spark, sf), ["c_custkey"], "seq")


def _loaded(spark, name, schema, path):
    """The files of a table just loaded, without leaving the table in the catalog."""
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).orc(path)


def _load(spark, sf, mode):
    name, path = f"checked_load_{uuid.uuid4().hex[:12]}", scratch_path(spark, "load")
    customer = table(spark, sf, "customer").selectExpr("c_custkey as id", "c_name as name")
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_name as name")
    day = "dt='20250719',part='it''s'"
    partitions.load_partition(customer, name, day, location=path)
    partitions.load_partition(customer, name, {"dt": "20250720", "part": "b"}, "insert")
    partitions.load_partition(supplier, name, day, mode, max_file_size="64KB")
    return _loaded(spark, name, spark.table(name).schema, path)


_OTHER_DAY = "select c_custkey as id, c_name as name, '20250720' as dt, 'b' as part from customer"
_SAME_DAY = "select s_suppkey, s_name, '20250719', 'it''s' from supplier"


@check(
    f"{_OTHER_DAY} union all {_SAME_DAY}"
    " union all select c_custkey, c_name, '20250719', 'it''s' from customer"
)
def load_partition_append(spark, sf):
    return _load(spark, sf, "insert")


@check(f"{_OTHER_DAY} union all {_SAME_DAY}")
def load_partition_overwrite(spark, sf):
    return _load(spark, sf, "overwrite")


@check("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def roll_files_by_size(spark, sf):
    orders = table(spark, sf, "orders").drop("o_orderdate")
    path = scratch_path(spark, "rolled")
    partitions.roll_files_by_size(orders, path, "128KB")
    return spark.read.schema(orders.schema).orc(path)


@check(
    """
    select doc_id::varchar as doc_id, replace(replace(text, chr(10), ' '), ',', ' ') as text,
           coalesce(case when doc_id % 6 <> 0 then lang end, '') as lang
    from documents
    """
)
def export_csv(spark, sf):
    rows = table(spark, sf, "documents").selectExpr(
        "doc_id", "text", "case when doc_id % 6 <> 0 then lang end as lang"
    )
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_delimited(spark, path, rows.columns, skip_header=True)


@check(
    """
    select event_id::varchar as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type,
           replace(props, ',', ' ') as props
    from events
    """
)
def write_delimited(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "event_type", "props")
    path = scratch_path(spark, "text")
    write_text(rows, path, "tab")
    return read_delimited(spark, path, rows.columns, "tab")


@check(
    """
    select o_orderkey, case when o_orderkey % 3 <> 0 then o_totalprice end as o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority
    from orders
    """
)
def export_json(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 3 <> 0 then o_totalprice end as o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    path = scratch_path(spark, "json")
    columnar.export_json(rows, path)
    return spark.read.schema(columnar.dates_as_text(rows).schema).json(path)


@check(
    """
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(ts, '%Y-%m-%d') as day, value,
           case when event_id % 3 <> 0 then event_type end as event_type
    from events
    """
)
def export_parquet(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "ts", "cast(ts as date) as day", "value",
        "case when event_id % 3 <> 0 then event_type end as event_type",
    )
    path = scratch_path(spark, "parquet")
    columnar.export_parquet(rows, path)
    return spark.read.schema(columnar.dates_as_text(rows).schema).parquet(path)


@check(
    """
    select chunk_id, count(*) as rows, min(o_orderkey) as first_key, max(o_orderkey) as last_key
    from (select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 4000 as chunk_id from orders)
    group by chunk_id
    """
)
def row_chunks(spark, sf):
    chunked = cut_rows(table(spark, sf, "orders"), 4000, ["o_orderkey"])
    return chunked.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@check(
    """
    with r as (select (row_number() over (order by c_custkey) - 1) // 400 as chunk_id,
                      concat_ws(',', c_custkey, c_name, c_mktsegment) as value from customer)
    select chunk_id, value from r
    union all select distinct chunk_id, 'c_custkey,c_name,c_mktsegment' from r
    """
)
def export_row_chunks(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = scratch_path(spark, "chunks")
    write_row_chunks(rows, path, 400, order_by=["c_custkey"])
    return spark.read.schema("value string, chunk_id bigint").text(path)


@check(
    """
    with r as (select row_number() over (order by c_custkey) - 1 as row_id, * from customer)
    select row_id, 1 as col_idx, c_custkey::varchar as value from r
    union all select row_id, 2, c_name from r
    union all select row_id, 3, case when c_custkey % 4 <> 0 then c_mktsegment end from r
    """
)
def column_chunks(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "case when c_custkey % 4 <> 0 then c_mktsegment end as c_mktsegment"
    )
    return unpivot_columns(number_rows(rows, ["c_custkey"]))


@check(
    """
    with r as (select (row_number() over (order by o_orderkey) - 1) // 4000 as chunk_id, o_orderkey, o_totalprice,
                      case when o_orderkey % 3 <> 0 then o_orderpriority end as o_orderpriority from orders),
         text as (select chunk_id, 1 as col_idx, o_orderkey::varchar as value, 'o_orderkey' as title from r
                  union all select chunk_id, 2, round(o_totalprice * 100)::bigint::varchar, 'cents' from r
                  union all select chunk_id, 3, coalesce(o_orderpriority, ''), 'o_orderpriority' from r)
    select 'text' as form, chunk_id, col_idx, value from text
    union all select distinct 'text', chunk_id, col_idx, title from text
    union all select 'parquet', chunk_id, 1, o_orderkey::varchar from r
    union all select 'parquet', chunk_id, 2, round(o_totalprice * 100)::bigint::varchar from r
    union all select 'parquet', chunk_id, 3, o_orderpriority from r
    """
)
def export_column_chunks(spark, sf):
    """The orders column by column, as text and typed."""
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(round(o_totalprice * 100) as bigint) as cents",
        "case when o_orderkey % 3 <> 0 then o_orderpriority end as o_orderpriority",
    )
    path = scratch_path(spark, "columns")
    write_column_chunks(orders, f"{path}/text", 4000, order_by=["o_orderkey"])
    write_column_chunks(orders, f"{path}/parquet", 4000, "parquet", order_by=["o_orderkey"])
    lines = spark.read.schema("value string, col_idx int, chunk_id bigint").text(f"{path}/text")
    found = lines.select(F.lit("text").alias("form"), "chunk_id", "col_idx", "value")
    for i, field in enumerate(orders.schema.fields, 1):
        typed = spark.read.schema(f"{field.name} {field.dataType.simpleString()}, chunk_id bigint").parquet(
            f"{path}/parquet/col_idx={i:010d}"
        )
        cells = typed.select(
            F.lit("parquet").alias("form"), "chunk_id", F.lit(i).alias("col_idx"), F.col(field.name).cast("string").alias("value")
        )
        found = found.unionAll(cells)
    return found


@check(
    """
    select count(*) as source_rows, count(*) filter (where o_totalprice > 100000) as read,
           count(*) filter (where o_totalprice > 100000) as written, true as matched
    from orders
    """
)
def count_check(spark, sf):
    """Counted while one job runs, against the rows found in the files."""
    source, passed = RowCounter("source"), RowCounter("passed")
    step = {"name": "filter", "parameter": {"columnIndex": 1, "op": ">", "value": "100000"}}
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    rows = passed.watch(apply_chain(source.watch(orders), [step]))
    path = scratch_path(spark, "counted")
    rows.write.parquet(path)
    found = spark.read.schema(rows.schema).parquet(path)
    return found.agg(F.count(F.lit(1)).alias("written")).select(
        F.lit(source.rows).cast("bigint").alias("source_rows"),
        F.lit(passed.rows).cast("bigint").alias("read"),
        "written",
        (F.col("written") == passed.rows).alias("matched"),
    )


@check(
    """
    select ceil(count(*) / 2500)::bigint as files, 6 as columns, count(*) as rows from orders
    """
)
def export_stats(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "stats")
    chunked = cut_rows(orders, 2500, ["o_orderkey"]).drop("row_id").repartition("chunk_id")
    chunked.write.partitionBy("chunk_id").parquet(path)
    return count_export(spark.read.parquet(path).drop("chunk_id"))


def _catalog_merge(spark, sf, mode):
    """A whole job merging the orders into a table of customers partitioned by segment."""
    name, path = f"checked_merge_{uuid.uuid4().hex[:12]}", scratch_path(spark, "table")
    _target(spark, sf).write.partitionBy("c_mktsegment").option("path", path).saveAsTable(name)
    source = ["c_custkey", "c_name", "c_acctbal", "seq"]
    job = {
        "job": {
            "sqlMode": 2,
            "content": [
                {
                    "reader": {"name": "Mysql", "parameter": {"table": "order_source", "column": source}},
                    "writer": {
                        "name": "Hive",
                        "parameter": {
                            "table": name,
                            "column": source[:3],
                            "writeMode": mode,
                            "primaryKey": ["c_custkey"],
                            "orderBy": "seq",
                        },
                    },
                }
            ],
        }
    }
    report = Job(spark, job, {"order_source": _source(spark, sf)}).run()
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    if not report["data"]["matched"]:
        raise ValueError(f"rows lost: {report}")
    return spark.read.schema(schema).parquet(path)


@check(CHECKS["merge_ignore"][1])
def catalog_merge_ignore(spark, sf):
    return _catalog_merge(spark, sf, "ignore")


@check(_UPDATE_SQL)
def catalog_merge_update(spark, sf):
    return _catalog_merge(spark, sf, "update")


@check(CHECKS["merge_replace"][1])
def catalog_merge_replace(spark, sf):
    return _catalog_merge(spark, sf, "replace")


@check(CHECKS["merge_insert"][1])
def catalog_merge_insert(spark, sf):
    name, path = f"checked_merge_{uuid.uuid4().hex[:12]}", scratch_path(spark, "table")
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    target.write.partitionBy("c_mktsegment").option("path", path).saveAsTable(name)
    source = table(spark, sf, "supplier").selectExpr("-s_suppkey - 1 as c_custkey", "s_name as c_name")
    merge_table(name, source, ["c_custkey"], "insert")
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)
