"""Streaks, star schema, SQL constructs, scripts and whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.inputs import collector, table
from rowbridge.common import scratch_path, stage, staging
from rowbridge.operators.numbering import number_rows
from rowbridge.plans import pipelines as flows
from rowbridge.plans.job import Job
from rowbridge.plans.script import run_script
from rowbridge.sinks.partitions import delete_where as delete_rows
from rowbridge.sinks.partitions import update_where as update_rows
from rowbridge.sources.delimited import read_delimited

CHECKS: dict = {}
check = collector(CHECKS)

# Days of a run share the number of breaks before them; places count the days up to each.
_DAYS = """
    active as (select user_id, cast(ts as date) as day from events group by all),
    marked as (select user_id, day, count(*) over w as place,
                      case when day - lag(day) over w = 1 then 0 else 1 end as breaks
               from active window w as (partition by user_id order by day)),
    runs as (select user_id, day, place, sum(breaks) over (partition by user_id order by day) as run from marked),
    spans as (select user_id, run, min(day) as first_day, max(day) as last_day,
                     min(day) - cast(min(place) as integer) as island
              from runs group by user_id, run)
"""


def _days(spark, sf):
    return flows.distinct_days(table(spark, sf, "events"), "user_id", "ts")


def _text(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


@check(
    f"""
    with {_DAYS}
    select user_id, last_day - first_day + 1 as max_consecutive_days, first_day || ' 至 ' || last_day as longest_period
    from spans
    qualify rank() over (partition by user_id order by last_day - first_day desc) = 1
    """
)
def longest_streaks(spark, sf):
    return flows.longest_streaks(table(spark, sf, "events"), "user_id", "ts", " 至 ")


@check(f"with {_DAYS} select user_id, day::varchar as day from active")
def distinct_days(spark, sf):
    return _text(_days(spark, sf), "day")


@check(f"with {_DAYS} select user_id, day::varchar as day, place::int as rn from runs")
def row_number_days(spark, sf):
    return _text(flows.numbered_days(_days(spark, sf)), "day")


@check(
    f"""
    with {_DAYS} select user_id, day::varchar as day, island::varchar as island
    from runs join spans using (user_id, run)
    """
)
def island_key(spark, sf):
    return _text(flows.island_keys(_days(spark, sf)), "day", "island")


@check(
    f"""
    with {_DAYS}
    select user_id, island::varchar as island, last_day - first_day + 1 as consecutive_days,
           first_day::varchar as period_start, last_day::varchar as period_end
    from spans
    """
)
def consecutive_periods(spark, sf):
    return _text(flows.consecutive_periods(_days(spark, sf)), "island", "period_start", "period_end")


# A denormalised sales feed: text discounts with and without a percent sign,
# order dates in two formats.
_SALES = """
    sales as (select l_orderkey as order_id, l_linenumber as line, p_type as product_name, n_name as region,
                     p_brand as sales_rep, l_quantity::int as quantity,
                     round(p_retailprice, 2)::decimal(10,2) as unit_price,
                     case when l_linenumber % 2 = 1 then round(l_discount * 100)::int || '%'
                          else (round(l_discount * 100)::int)::varchar end as discount,
                     case when l_orderkey % 3 = 0 then strftime(l_shipdate, '%d/%m/%Y')
                          else strftime(l_shipdate, '%Y-%m-%d') end as order_date, l_shipdate
              from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
                   join nation on s_nationkey = n_nationkey)
"""
_PRODUCTS = """
    products as (select row_number() over (order by product_name) as product_id, product_name,
                        case when product_name in ('PROMO', 'ECONOMY') then 'Offers'
                             when product_name in ('STANDARD', 'SMALL', 'MEDIUM') then 'Regular'
                             else 'Other' end as category
                 from (select distinct p_type as product_name from part)),
    regions as (select row_number() over (order by n_name) as region_id, n_name as region_name
                from (select distinct n_name from nation)),
    reps as (select row_number() over (order by p_brand) as sales_rep_id, p_brand as sales_rep_name
             from (select distinct p_brand from part))
"""
_FACT = f"""
    {_SALES}, {_PRODUCTS},
    fact as (select order_id, line, product_id, quantity, unit_price,
                    (quantity * unit_price)::decimal(12,2) as total_price,
                    (quantity * unit_price * replace(discount, '%', '')::decimal(5,2) * 0.01)::decimal(10,2)
                        as discount_amount,
                    l_shipdate::date as order_date, region_id, sales_rep_id
             from sales s join products p on s.product_name = p.product_name
                  join regions r on s.region = r.region_name join reps on s.sales_rep = reps.sales_rep_name)
"""


def _sales(spark, sf):
    lineitem, part, supplier, nation = (
        table(spark, sf, t) for t in ("lineitem", "part", "supplier", "nation")
    )
    joined = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as line",
        "p_type as product_name",
        "n_name as region",
        "p_brand as sales_rep",
        "cast(l_quantity as int) as quantity",
        "cast(round(p_retailprice, 2) as decimal(10,2)) as unit_price",
        "concat(cast(round(l_discount * 100) as int), if(l_linenumber % 2 = 1, '%', '')) as discount",
        "if(l_orderkey % 3 = 0, date_format(l_shipdate, 'dd/MM/yyyy'),"
        " date_format(l_shipdate, 'yyyy-MM-dd')) as order_date",
    )


_CATEGORIES = {"Offers": ["PROMO", "ECONOMY"], "Regular": ["STANDARD", "SMALL", "MEDIUM"]}


def _dimensions(spark, sf):
    part, nation = table(spark, sf, "part"), table(spark, sf, "nation")
    products = part.select(
        F.col("p_type").alias("product_name"),
        flows.categorize(F.col("p_type"), _CATEGORIES).alias("category"),
    )
    return (
        flows.load_dimension(None, products, "product_name", "product_id"),
        flows.load_dimension(None, nation.selectExpr("n_name as region_name"), "region_name", "region_id"),
        flows.load_dimension(None, part.selectExpr("p_brand as sales_rep_name"), "sales_rep_name", "sales_rep_id"),
    )


def _fact(spark, sf, dimensions=None):
    products, regions, reps = dimensions or _dimensions(spark, sf)
    amount = F.col("quantity") * F.col("unit_price")
    joined = flows.load_fact(
        _sales(spark, sf),
        [
            (products, "product_name", "product_id", "product_name"),
            (regions, "region_name", "region_id", "region"),
            (reps, "sales_rep_name", "sales_rep_id", "sales_rep"),
        ],
    )
    return joined.select(
        "order_id",
        "line",
        "product_id",
        "quantity",
        "unit_price",
        amount.cast("decimal(12,2)").alias("total_price"),
        flows.parse_discount(amount, F.col("discount")).cast("decimal(10,2)").alias("discount_amount"),
        flows.mixed_dates(F.col("order_date")).alias("order_date"),
        "region_id",
        "sales_rep_id",
    )


@check(
    """
    with known as (select row_number() over (order by p_brand) * 10 as brand_id, p_brand as brand, 'known' as origin
                   from (select distinct p_brand from part where p_size <= 2)),
         fresh as (select p_brand as brand, min(p_type) as origin from part group by p_brand),
         top as (select coalesce(max(brand_id), 0) as top from known)
    select * from known union all
    select top + row_number() over (order by brand), brand, origin from fresh, top
    where brand not in (select brand from known)
    """
)
def load_dimension(spark, sf):
    part = table(spark, sf, "part")
    early = part.where("p_size <= 2").select("p_brand").distinct()
    known = number_rows(early, ["p_brand"], "n").selectExpr(
        "(n + 1) * 10 as brand_id", "p_brand as brand", "'known' as origin"
    )
    fresh = part.selectExpr("p_brand as brand", "p_type as origin")
    return flows.load_dimension(known, fresh, "brand", "brand_id")


@check(f"with {_PRODUCTS} select p_partkey, category from part join products on p_type = product_name")
def categorize(spark, sf):
    category = flows.categorize(F.col("p_type"), _CATEGORIES).alias("category")
    return table(spark, sf, "part").select("p_partkey", category)


@check(f"with {_FACT} select * exclude (order_date), order_date::varchar as order_date from fact")
def load_fact(spark, sf):
    return _text(_fact(spark, sf), "order_date")


@check(
    f"""
    with {_SALES}
    select order_id, line, (quantity * unit_price * replace(discount, '%', '')::decimal(5,2) * 0.01)::decimal(12,4)
           ::varchar as discount_amount
    from sales
    """
)
def parse_discount(spark, sf):
    share = flows.parse_discount(F.col("quantity") * F.col("unit_price"), F.col("discount"))
    return _sales(spark, sf).select(
        "order_id", "line", share.cast("decimal(12,4)").cast("string").alias("discount_amount")
    )


@check(f"with {_SALES} select order_id, line, strftime(l_shipdate, '%Y-%m-%d') as order_date from sales")
def mixed_dates(spark, sf):
    day = flows.mixed_dates(F.col("order_date")).cast("string").alias("order_date")
    return _sales(spark, sf).select("order_id", "line", day)


_SUMMARY = """
    summary as (select strftime(order_date, '%Y-%m-01') as summary_date, region_name, category as product_category,
                       sum(total_price - discount_amount) as total_sales, sum(quantity)::bigint as total_quantity,
                       avg(discount_amount::double / total_price::double * 100) as avg_discount
                from fact f join regions r on f.region_id = r.region_id
                     join products p on f.product_id = p.product_id
                group by all)
"""


def _named_fact(spark, sf):
    dimensions = _dimensions(spark, sf)
    products, regions, _ = dimensions
    fact = _fact(spark, sf, dimensions).select(
        "product_id",
        "region_id",
        "quantity",
        "order_date",
        (F.col("total_price") - F.col("discount_amount")).alias("final_price"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("total_price").cast("double").alias("total_price"),
    )
    named = fact.join(regions, "region_id").join(products.withColumnRenamed("category", "product_category"), "product_id")
    return named


_MEASURES = (
    "order_date",
    ["region_name", "product_category"],
    "final_price",
    "quantity",
    "discount_amount",
    "total_price",
)


def _summary(spark, sf):
    return flows.summarize(_named_fact(spark, sf), *_MEASURES)


@check(
    f"""
    with {_FACT}, {_SUMMARY}
    select summary_date, region_name, product_category, total_sales::decimal(18,2)::varchar as total_sales,
           total_quantity, round(avg_discount, 6) as avg_discount
    from summary
    """
)
def sales_summary(spark, sf):
    return _stable(_summary(spark, sf))


@check(
    f"""
    with {_FACT}, {_SUMMARY}
    select summary_date, region_name, product_category, total_sales::decimal(18,2)::varchar as total_sales,
           total_quantity, round(avg_discount, 6) as avg_discount
    from summary
    """
)
def incremental_summary(spark, sf):
    """Facts in two loads, the later one run twice: their states give the summary of all facts."""
    name, path = f"checked_states_{uuid.uuid4().hex[:12]}", scratch_path(spark, "states")
    older = F.col("order_date") < "1995-06-17"
    with staging(spark):
        fact = stage(_named_fact(spark, sf), "facts")  # joined once for all loads
        for load, rows in (("a", fact.where(older)), ("b", fact.where(~older)), ("b", fact.where(~older))):
            flows.load_states(flows.summary_states(rows, *_MEASURES), name, load, path)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    states = spark.read.schema(schema).parquet(path)
    return _stable(flows.summary_of_states(states, _MEASURES[1]))


def _stable(summary):
    return summary.select(
        F.col("summary_date").cast("string").alias("summary_date"),
        "region_name",
        "product_category",
        F.col("total_sales").cast("decimal(18,2)").cast("string").alias("total_sales"),
        "total_quantity",
        F.round("avg_discount", 6).alias("avg_discount"),
    )


@check(
    f"""
    with {_FACT}, {_SUMMARY},
         old as (select '1990-01-01' as summary_date, n_name as region_name, 'Other' as product_category from nation
                 union all select distinct summary_date, region_name, product_category from summary
                 where product_category <> 'Offers')
    select coalesce(s.summary_date, o.summary_date) as summary_date,
           coalesce(s.region_name, o.region_name) as region_name,
           coalesce(s.product_category, o.product_category) as product_category,
           case when s.region_name is null then '0.00' else total_sales::decimal(18,2)::varchar end as total_sales,
           case when s.region_name is null then 0 else total_quantity end as total_quantity,
           case when s.region_name is null then 0.0::double else round(avg_discount, 6) end as avg_discount
    from summary s full join old o on s.summary_date = o.summary_date and s.region_name = o.region_name
         and s.product_category = o.product_category
    """
)
def upsert_summary(spark, sf):
    """An older summary with stale values and rows the new one lacks."""
    summary = stage(_summary(spark, sf), "summary")
    blank = [
        F.lit(0).cast(summary.schema["total_sales"].dataType).alias("total_sales"),
        F.lit(0).cast("bigint").alias("total_quantity"),
        F.lit(0.0).alias("avg_discount"),
    ]
    stale = summary.where("product_category <> 'Offers'").select(
        "summary_date", "region_name", "product_category", *blank
    )
    gone = table(spark, sf, "nation").select(
        F.lit("1990-01-01").cast("date").alias("summary_date"),
        F.col("n_name").alias("region_name"),
        F.lit("Other").alias("product_category"),
        *blank,
    )
    groups = ["region_name", "product_category"]
    return _stable(flows.upsert_summary(stale.unionByName(gone), summary, groups))


@check(
    """
    select l_orderkey, l_linenumber, p_type, n_name, strftime(l_shipdate, '%Y-%m-%d') as day
    from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
         join nation on s_nationkey = n_nationkey
    order by l_shipdate desc, l_orderkey, l_linenumber, l_extendedprice limit 5
    """
)
def recent_facts(spark, sf):
    lineitem, part, supplier, nation = (
        table(spark, sf, t) for t in ("lineitem", "part", "supplier", "nation")
    )
    joined = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    top = flows.recent_facts(joined, "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"])
    return top.select(
        "l_orderkey", "l_linenumber", "p_type", "n_name", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")
    )


_NULLABLE_STATUS = "case when o_orderkey % 5 <> 0 then o_orderstatus end as status"


@check(
    f"""
    select * from (select o_orderkey, o_totalprice, {_NULLABLE_STATUS} from orders)
    where not coalesce(status = 'F' and o_totalprice > 50000, false)
    """
)
def delete_where(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", _NULLABLE_STATUS)
    return delete_rows(rows, "status = 'F' and o_totalprice > 50000")


@check(
    f"""
    select o_orderkey, case when status = 'F' then -o_totalprice else o_totalprice end as o_totalprice,
           case when status = 'F' then 'done' else status end as status
    from (select o_orderkey, o_totalprice, {_NULLABLE_STATUS} from orders)
    """
)
def update_where(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", _NULLABLE_STATUS)
    return update_rows(rows, "status = 'F'", {"o_totalprice": "-o_totalprice", "status": "'done'"})


_SCRIPT = """
-- totals; of orders
create or replace temporary view script_totals as
  select o_custkey, count(*) as orders, max(o_orderpriority) as priority from script_orders group by o_custkey;
/* an intermediate result; not wanted */
select * from script_totals where priority = 'a;b';
with busy as (select * from script_totals where orders > 10)
select c_custkey, c_name, orders, priority from busy join script_customer on c_custkey = o_custkey
order by orders desc, c_custkey;
"""


@check(
    """
    with busy as (select o_custkey, count(*) as orders, max(o_orderpriority) as priority from orders
                  group by o_custkey having count(*) > 10)
    select c_custkey, c_name, orders, priority from busy join customer on c_custkey = o_custkey
    order by orders desc, c_custkey
    """
)
def script_last_result(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("script_orders")
    table(spark, sf, "customer").createOrReplaceTempView("script_customer")
    return run_script(spark, _SCRIPT)


@check(
    """
    select o_orderkey::varchar as o_orderkey, replace(trim(o_orderpriority), '-', '_') as o_orderpriority,
           o_totalprice::varchar as o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate
    from orders where o_orderstatus = 'F' and o_totalprice > 20000
    """
)
def move_job(spark, sf):
    """A whole job: table scan, transformer chain, text sink, count check, read-back."""
    path = scratch_path(spark, "job")
    columns = ["o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate"]
    job = {
        "job": {
            "sqlMode": 2,
            "setting": {"speed": {"channel": 4}},
            "content": [
                {
                    "reader": {
                        "name": "Mysql",
                        "parameter": {"table": "orders", "column": columns, "where": "o_orderstatus = 'F'"},
                    },
                    "transformer": [
                        "trim",
                        {
                            "name": "replace",
                            "parameter": {"columnIndex": [1], "oldValue": "-", "newValue": "_"},
                        },
                        {"name": "filter", "parameter": {"columnIndex": [2], "op": ">", "value": "20000"}},
                    ],
                    "writer": {"name": "TxtFile", "parameter": {"filePath": path, "sep": "\\t"}},
                }
            ],
        }
    }
    report = Job(spark, job, {"orders": table(spark, sf, "orders")}).run()
    rows = read_delimited(spark, path, columns, "tab")
    if not report["data"]["matched"]:
        raise ValueError(f"rows lost: {report}")
    return rows


_TABLE_SCRIPT = """
delete from {name} where o_orderstatus = 'P' or o_totalprice < 2000;
update {name} set o_totalprice = -o_totalprice, o_orderpriority = concat(o_orderpriority, '; moved'), o_orderstatus = 'X'
  where o_orderpriority = '1-URGENT' and o_orderdate < timestamp'1993-01-01';
select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from {name}
"""


@check(
    """
    with o as (select *, o_orderpriority = '1-URGENT' and o_orderdate < timestamp '1993-01-01' as hit
               from orders where not (o_orderstatus = 'P' or o_totalprice < 2000))
    select o_orderkey, case when hit then 'X' else o_orderstatus end as o_orderstatus,
           case when hit then -o_totalprice else o_totalprice end as o_totalprice,
           case when hit then o_orderpriority || '; moved' else o_orderpriority end as o_orderpriority
    from o
    """
)
def script_changes_table(spark, sf):
    """DELETE and UPDATE on a plain partitioned table, where the update opens a new partition."""
    name, path = f"checked_orders_{uuid.uuid4().hex[:12]}", scratch_path(spark, "table")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate", "o_orderstatus"
    )
    orders.write.partitionBy("o_orderstatus").option("path", path).saveAsTable(name)
    columns = run_script(spark, _TABLE_SCRIPT.format(name=name)).columns
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path).select(*columns)
