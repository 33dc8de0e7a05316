"""Scans, splits, delimited text and cell tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import collector, table
from rowbridge.common import scratch_path
from rowbridge.operators.cells import cells_to_rows, rows_to_cells
from rowbridge.operators.splits import (
    range_splits as count_range_splits,
    read_range_partitioned,
    rowkey_range_splits as tag_rowkey_ranges,
    rowkey_region_splits as tag_rowkey_regions,
)
from rowbridge.sinks.delimited import write_delimited as write_text
from rowbridge.sources import tables as scans
from rowbridge.sources.delimited import read_delimited as read_text
from rowbridge.sources.predicates import predicate_scan as scan_ranges

CHECKS: dict = {}
check = collector(CHECKS)


@check(
    """
    select o_orderkey, o_custkey, o_totalprice from orders
    where o_orderstatus = 'F' and o_totalprice > 100000 order by o_totalprice desc, o_orderkey
    """
)
def extract_table(spark, sf):
    return scans.extract_table(
        table(spark, sf, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice"],
        "and o_orderstatus = 'F' and o_totalprice > 100000",
        "o_totalprice desc, o_orderkey",
    )


@check(
    """
    select c_mktsegment, total from (
        select c_mktsegment, c_nationkey, count(*) as total from customer group by all) t
    where c_nationkey < 20 and total > 1 order by c_nationkey
    """
)
def extract_query(spark, sf):
    return scans.extract_query(
        spark,
        "select c_mktsegment, c_nationkey, count(*) as total from {customer} group by all",
        ["c_mktsegment", "total"],
        "c_nationkey < 20 and total > 1",
        "c_nationkey",
        customer=table(spark, sf, "customer"),
    )


_SPLITS = """
    b as (select min(k) as lo, max(k) as hi, (max(k) - min(k) + 1) // 7 as step from t),
    s as (select i::int as split_id, lo + i * step as lo,
                 case when i = 6 then hi else lo + i * step + step - 1 end as hi
          from b, range(7) r(i))
"""


@check(
    f"""
    with t as (select o_orderkey as k from orders), {_SPLITS}
    select split_id, s.lo, s.hi, count(k) as rows
    from s left join t on k between s.lo and s.hi group by all
    """
)
def range_splits(spark, sf):
    return count_range_splits(table(spark, sf, "orders"), "o_orderkey", 7)


@check(
    f"""
    with t as (select case when o_orderkey % 11 <> 0 then o_custkey end as k, * from orders), {_SPLITS}
    select o_orderkey, k, coalesce(split_id, 7)::int as split_id
    from t left join s on k between s.lo and s.hi where o_orderstatus = 'O'
    """
)
def range_partitioned_read(spark, sf):
    orders = table(spark, sf, "orders").selectExpr(
        "case when o_orderkey % 11 <> 0 then o_custkey end as k", "*"
    )
    return read_range_partitioned(orders, "k", 7, "o_orderstatus = 'O'", ["o_orderkey", "k"])


@check(CHECKS["range_partitioned_read"][1])
def predicate_scan(spark, sf):
    """The orders in files of neighbouring customers; each range opens the files that can hold it."""
    path = scratch_path(spark, "ranges")
    keyed = table(spark, sf, "orders").selectExpr("case when o_orderkey % 11 <> 0 then o_custkey end as k", "*")
    keyed.repartitionByRange(16, "k").write.parquet(path)
    return scan_ranges(spark, path, "k", 7, "o_orderstatus = 'O'", ["o_orderkey", "k"])


@check(
    """
    select c_custkey::varchar as c_custkey, c_name, c_nationkey::varchar as c_nationkey,
           c_acctbal::varchar as c_acctbal, c_mktsegment
    from customer
    """
)
def read_delimited(spark, sf):
    customer = table(spark, sf, "customer")
    path = scratch_path(spark, "text")
    write_text(customer, path, "pipe")
    return read_text(spark, path, customer.columns, "pipe")


@check(
    """
    select c_custkey::varchar as key, c_name as name, c_acctbal::varchar as balance from customer
    union all select s_suppkey::varchar, s_name, s_acctbal::varchar from supplier
    """
)
def read_delimited_multi(spark, sf):
    names = ["key", "name", "balance"]
    paths = []
    for source, columns in (
        ("customer", ["c_custkey", "c_name", "c_acctbal"]),
        ("supplier", ["s_suppkey", "s_name", "s_acctbal"]),
    ):
        paths.append(scratch_path(spark, "text"))
        write_text(table(spark, sf, source).select(*columns).repartition(3), paths[-1], "\t", header=True)
    return read_text(spark, paths, names, "\\t", skip_header=True)


@check("select p_partkey, p_name as label, p_size as size from part where p_size > 10")
def read_catalog_table(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("checked_part")
    return scans.read_catalog_table(
        spark, "checked_part", ["checked_part.p_partkey", "p_name label", "p_size as size"], "p_size > 10"
    )


CUSTOMER_CELLS = [
    {"name": "cf:c_custkey", "type": "string"},
    {"name": "cf:c_name", "type": "string"},
    {"name": "cf:c_nationkey", "type": "int"},
    {"name": "cf:c_acctbal", "type": "double"},
    {"name": "cf:c_mktsegment", "type": "string"},
]


@check(
    """
    select c_custkey::varchar as c_custkey, c_name, c_nationkey, c_acctbal,
           case when c_custkey % 5 = 0 then '' else c_mktsegment end as c_mktsegment
    from customer
    """,
    "cells_to_rows",
)
def cell_rows(spark, sf):
    """Two writes of every row: the older ones must lose."""
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "case when c_custkey % 5 <> 0 then c_mktsegment end as c_mktsegment",
    )
    newer = rows_to_cells(customer, "c_custkey", CUSTOMER_CELLS).withColumn("version", F.lit(2))
    stale = customer.selectExpr(
        "c_custkey", "'old' as c_name", "-1 as c_nationkey", "-c_acctbal as c_acctbal", "c_mktsegment"
    )
    older = rows_to_cells(stale, "c_custkey", CUSTOMER_CELLS).withColumn("version", F.lit(1))
    return cells_to_rows(older.unionByName(newer), "c_custkey", CUSTOMER_CELLS)


_CELL_SQL = """
    select c_custkey::varchar as rowkey, 'cf' as family, 'c_name' as qualifier, hex(c_name) as value
    from customer
    union all select c_custkey::varchar, 'cf', 'c_nationkey', printf('%016X', c_nationkey::bigint)
    from customer
    union all select c_custkey::varchar, 'cf', 'c_balance_cents',
        case when cents >= 0 then printf('%016X', cents)
             else printf('%016X', cents::hugeint + 18446744073709551616) end
    from (select c_custkey, cast(round(c_acctbal * 100) as bigint) as cents from customer)
"""


@check(_CELL_SQL, "rows_to_cells")
def row_cells(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "cast(round(c_acctbal * 100) as bigint) as c_balance_cents"
    )
    declared = [
        {"name": "cf:c_custkey", "type": "string"},
        {"name": "cf:c_name", "type": "string"},
        {"name": "cf:c_nationkey", "type": "int"},
        {"name": "cf:c_balance_cents", "type": "long"},
    ]
    cells = rows_to_cells(customer, "c_custkey", declared)
    return cells.select("rowkey", "family", "qualifier", F.hex("value").alias("value"))


@check(
    """
    select user_id::varchar as rowkey, 'cf' as family, 'event_type' as qualifier,
           arg_max(event_type, event_id) as value, max(event_id) as version
    from events group by user_id
    """
)
def latest_cell_writes(spark, sf):
    """Every event writes its user's cell; the last write stays."""
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id")
    writes = rows_to_cells(events, "user_id", ["user_id", "event_type"], order_by="event_id")
    return writes.withColumn("value", F.col("value").cast("string"))


@check(
    """
    with k as (select c_custkey::varchar as rowkey from customer),
         r as (select * from (values (0, '0', '2499999999'), (1, '2499999999', '4999999999'),
                                     (2, '4999999999', '7499999999'), (3, '7499999999', '9999999999'))
               t(split_id, lo, hi))
    select split_id, count(*) as rows, min(rowkey) as first_key
    from r join k on rowkey >= lo and rowkey < hi group by split_id
    """
)
def rowkey_range_splits(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("rowkey"))
    tagged = tag_rowkey_ranges(keys, "rowkey", "0", "9999999999", 4)
    return tagged.groupBy("split_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("rowkey").alias("first_key")
    )


@check(
    """
    select 5::bigint as regions, true as even, true as apart, count(distinct user_id)::bigint as keys, count(*) as rows
    from events
    """
)
def rowkey_region_splits(spark, sf):
    """Regions of the events' users: sizes within a tenth, no overlap, every row in one."""
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("rowkey"))
    regions = tag_rowkey_regions(events, "rowkey", 5).groupBy("split_id").agg(
        F.count_distinct("rowkey").alias("keys"),
        F.count(F.lit(1)).alias("rows"),
        F.min("rowkey").alias("low"),
        F.max("rowkey").alias("high"),
    )
    following = regions.select((F.col("split_id") - 1).alias("split_id"), F.col("low").alias("next"))
    joined = regions.join(following, "split_id", "left_outer")
    share = F.sum("keys") / F.count(F.lit(1))
    return joined.agg(
        F.count(F.lit(1)).alias("regions"),
        # Few users give regions of a few keys, where one key more or less is no unevenness.
        ((F.min("keys") >= share * 0.9 - 1) & (F.max("keys") <= share * 1.1 + 1)).alias("even"),
        F.every(F.col("next").isNull() | (F.col("high") < F.col("next"))).alias("apart"),
        F.sum("keys").alias("keys"),
        F.sum("rows").alias("rows"),
    )
