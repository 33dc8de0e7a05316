"""Row transformers, conversions and text forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import collector, table
from rowbridge.common import scratch_path, session_setting
from rowbridge.functions import kinds
from rowbridge.operators import targets
from rowbridge.operators.transforms import apply_chain, register, register_batches
from rowbridge.sinks.columnar import export_orc, legacy_orc

CHECKS: dict = {}
check = collector(CHECKS)


def _step(name, **parameter):
    return {"name": name, "parameter": parameter}


@check(
    r"""
    select o_orderkey, regexp_replace(p, '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g') as p, o_orderpriority
    from (select o_orderkey, o_orderpriority, case when o_orderkey % 7 = 0 then null
          else concat(' ', chr(9), chr(1), o_orderpriority, ' x', chr(10), ' ') end as p from orders)
    """
)
def t_trim(spark, sf):
    padded = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 7 = 0 then null"
        " else concat(' ', chr(9), chr(1), o_orderpriority, ' x', chr(10), ' ') end as p",
        "o_orderpriority",
    )
    return apply_chain(padded, [_step("trim", columnIndex=[0, 1])])


@check(
    "select doc_id, replace(text, 'the ', 'THE.* ') as text, replace(lang, 'the ', 'THE.* ') as lang from documents"
)
def t_replace(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return apply_chain(documents, [_step("replace", oldValue="the ", newValue="THE.* ")])


_FILTERED = "case when o_orderkey % 7 = 0 then null else o_totalprice end"
_KEYED = "case when o_orderkey % 5 = 0 then null else o_orderstatus end"


def _filter(spark, sf, index, op, value):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"{_FILTERED} as price", f"{_KEYED} as status"
    )
    return apply_chain(rows, [_step("filter", columnIndex=index, op=op, value=value)])


def _filter_sql(condition):
    return f"""
    select * from (select o_orderkey, {_FILTERED} as price, {_KEYED} as status from orders)
    where {condition}
    """


@check(_filter_sql("status is not distinct from 'F'"))
def t_filter_eq(spark, sf):
    return _filter(spark, sf, [2], "=", "F")


@check(_filter_sql("status is distinct from 'F'"))
def t_filter_ne(spark, sf):
    return _filter(spark, sf, "2", "!=", "F")


@check(_filter_sql("price > 150000"))
def t_filter_gt(spark, sf):
    return _filter(spark, sf, 1, ">", 150000)


@check(_filter_sql("price < 50000.5"))
def t_filter_lt(spark, sf):
    return _filter(spark, sf, [2, 1], "<", "50000.5")


@check(_filter_sql("o_orderkey >= 100"))
def t_filter_ge(spark, sf):
    return _filter(spark, sf, [0], ">=", "100")


@check(_filter_sql("o_orderkey <= 100"))
def t_filter_le(spark, sf):
    return _filter(spark, sf, [0], "<=", "100")


@check(
    """
    select event_id, case when event_id % 9 = 0 then 'not a date'
                          else strftime(ts, '%d/%m/%Y %H%M%S') end as at,
           strftime(ts, '%d/%m/%Y %H%M%S') as ts
    from events
    """
)
def t_dateformat(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_id % 9 = 0 then 'not a date'"
        " else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as at",
        "ts",
    )
    step = _step(
        "dateformat", columnIndex=[1, 2], fromFormat="yyyy-MM-dd HH:mm:ss", toFormat="dd/MM/yyyy HHmmss"
    )
    return apply_chain(rows, [step])


@check("select doc_id, md5(text) as text, md5(lang) as lang, n_chars from documents")
def t_md5(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    return apply_chain(rows, ["MD5Encrypt"])


@check(
    """
    select doc_id, case quality when 0 then 'false' when 1 then 'true' else quality::varchar end as quality,
           case toxic::varchar when '0' then 'false' when '1' then 'true' end as toxic,
           case quality + 1 + toxic when 1 then 'true' else (quality + 1 + toxic)::varchar end as other
    from labels
    """
)
def t_zero_one(spark, sf):
    rows = table(spark, sf, "labels").selectExpr(
        "doc_id", "quality", "cast(toxic as string) as toxic", "quality + 1 + toxic as other"
    )
    return apply_chain(rows, [_step("zeroonetoboolean", columnIndex=[1, 2, 3])])


@check(
    """
    select o_orderkey, md5(replace(trim(o_orderpriority), '-', '_')) as p, o_totalprice from orders
    where o_totalprice > 20000
    """
)
def t_chain(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat('  ', o_orderpriority, ' ') as p", "o_totalprice"
    )
    return apply_chain(
        rows,
        [
            _step("trim", columnIndex=[1]),
            _step("replace", columnIndex=[1], oldValue="-", newValue="_"),
            _step("filter", columnIndex=[2], op=">", value="20000"),
            _step("md5encrypt", columnIndex=[1]),
        ],
    )


@register("uppersegment")
def _upper_segment(df, parameter):
    return df.withColumn(parameter["column"], F.upper(parameter["column"]))


# A lambda travels to the executors whole; a named function of this module would
# have to be importable there.
register_batches(
    "maskname",
    lambda batch, parameter: batch.assign(
        c_name=batch["c_name"].str.replace(parameter["mask"], "#", regex=False)
    ),
)


@check(
    "select c_custkey, replace(c_name, '0', '#') as c_name, upper(c_mktsegment) as c_mktsegment from customer"
)
def t_custom(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return apply_chain(
        rows, [_step("UpperSegment", column="c_mktsegment"), _step("maskname", mask="0")]
    )


@check(
    """
    select p_partkey, p_size::bigint as p_size, (p_size % 100)::varchar as tiny,
           p_retailprice::decimal(12,2)::varchar as price, (p_size * 0.5)::double as half, p_size > 20 as big
    from part
    """
)
def canonicalize(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "p_size",
        "cast(p_size % 100 as smallint) as tiny",
        "cast(p_retailprice as decimal(12,2)) as price",
        "cast(p_size * 0.5 as float) as half",
        "p_size > 20 as big",
    )
    return kinds.canonicalize(rows)


@check(
    """
    select o_orderkey, o_orderkey * (case when o_orderkey % 2 = 0 then -1 else 1 end) as whole,
           o_orderkey * 100 as exponent,
           case when o_orderkey % 3 = 0 then null else o_orderkey end as checked
    from orders
    """
)
def convert_string_long(spark, sf):
    text = T.StringType()
    return (
        table(spark, sf, "orders")
        .selectExpr(
            "o_orderkey",
            "concat(if(o_orderkey % 2 = 0, '-', '+'), o_orderkey, '.99') as whole",
            "concat(o_orderkey, '.000e2') as exponent",
            "if(o_orderkey % 3 = 0, concat(o_orderkey, ' rows'), cast(o_orderkey as string)) as checked",
        )
        .select(
            "o_orderkey",
            kinds.convert(F.col("whole"), text, "LONG").alias("whole"),
            kinds.convert(F.col("exponent"), text, "LONG").alias("exponent"),
            kinds.convert(F.col("checked"), text, "LONG", "null").alias("checked"),
        )
    )


@check(
    """
    select doc_id, quality = 1 as strict,
           case when doc_id % 4 = 0 then null else quality = 1 end as lenient
    from labels
    """
)
def convert_string_bool(spark, sf):
    text = T.StringType()
    rows = table(spark, sf, "labels").selectExpr(
        "doc_id",
        "if(quality = 1, 'TRUE', 'False') as strict",
        "case when doc_id % 4 = 0 then 'yes' when quality = 1 then 'true' else 'false' end as lenient",
    )
    return rows.select(
        "doc_id",
        kinds.convert(F.col("strict"), text, "BOOL").alias("strict"),
        kinds.convert(F.col("lenient"), text, "BOOL", "null").alias("lenient"),
    )


_MIXED_TEXT = """
    case event_id % 4 when 0 then {dt} when 1 then {d} when 2 then {t} else 'none' end
"""


@check(
    """
    select event_id, case event_id % 4
        when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S')
        when 1 then strftime(ts, '%Y-%m-%d 00:00:00')
        when 2 then strftime(ts, '1970-01-01 %H:%M:%S') end as parsed
    from events
    """
)
def convert_string_date(spark, sf):
    rows = _mixed_events(spark, sf)
    parsed = kinds.convert(F.col("raw"), T.StringType(), "DATE", "null")
    return rows.select("event_id", kinds.render(parsed, T.TimestampType()).alias("parsed"))


def _mixed_events(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id",
        _MIXED_TEXT.format(
            dt="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
            d="date_format(ts, 'yyyy-MM-dd')",
            t="date_format(ts, 'HH:mm:ss')",
        )
        + " as raw",
    )


@check(
    """
    select event_id, coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y-%m-%d'),
                              try_strptime('1970-01-01 ' || raw, '%Y-%m-%d %H:%M:%S'))::varchar as parsed
    from (select event_id, case event_id % 4 when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S')
          when 1 then strftime(ts, '%Y-%m-%d') when 2 then strftime(ts, '%H:%M:%S') else 'none' end as raw
          from events)
    """
)
def parse_dates(spark, sf):
    parsed = kinds.parse_dates(F.col("raw"))
    rows = _mixed_events(spark, sf)
    return rows.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@check(
    """
    select event_id, epoch_us(ts) // 1000 as ms, strftime(ts, '%Y-%m-%d %H:%M:%S') as back from events
    """
)
def convert_date_long(spark, sf):
    events = table(spark, sf, "events").selectExpr("event_id", "ts")
    ms = kinds.convert(F.col("ts"), events.schema["ts"].dataType, "LONG")
    back = kinds.convert(F.col("ms"), T.LongType(), "DATE")
    # Wall-clock times become instants in the zone the plan is built under.
    with session_setting(spark, "spark.sql.session.timeZone", "UTC"):
        rows = events.select("event_id", ms.alias("ms"))
        return rows.select("event_id", "ms", kinds.render(back, T.TimestampType()).alias("back"))


@check(
    """
    select doc_id, toxic::bigint as as_long, toxic::double as as_double, toxic <> 0 as from_long,
           case when toxic = 1 then 'true' else 'false' end as as_text
    from labels
    """
)
def convert_bool_num(spark, sf):
    flag, kind = F.col("toxic") == 1, T.BooleanType()
    return table(spark, sf, "labels").select(
        "doc_id",
        kinds.convert(flag, kind, "LONG").alias("as_long"),
        kinds.convert(flag, kind, "DOUBLE").alias("as_double"),
        kinds.convert(F.col("toxic"), T.IntegerType(), "BOOL").alias("from_long"),
        kinds.convert(flag, kind, "STRING").alias("as_text"),
    )


@check(
    """
    select event_id::varchar as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts,
           strftime(ts, '%Y-%m-%d') as day,
           case when event_id * 1000 < 10000000 then (event_id * 1000)::varchar || '.0'
                else (event_id * 1000)::varchar end as big,
           case when event_id % 2 = 0 then 'true' else 'false' end as even, event_type
    from events
    """
)
def render_text(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "ts",
        "cast(ts as date) as day",
        "cast(event_id * 1000 as double) as big",
        "event_id % 2 = 0 as even",
        "cast(event_type as binary) as event_type",
    )
    return kinds.render_text(rows)


@check(
    """
    select o_orderkey, case when o_orderkey % 10 = 0 then o_orderkey::varchar || '00000000000000000000'
                            else o_orderkey::varchar end as amount
    from orders where o_orderkey % 10 = 0 and o_orderkey > 0
    """
)
def validate_range(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderkey % 10 = 0, concat(o_orderkey, '00000000000000000000'), cast(o_orderkey as string))"
        " as amount",
    )
    return kinds.validate_range(rows, "amount", "LONG")


@check("select p_partkey, left(p_name, 5) as p_name, left(p_type, 3) as p_type, p_brand from part")
def fit_to_width(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return targets.fit_to_width(rows, {"p_name": 5, "p_type": 3, "p_brand": 0})


@check(
    """
    select o_orderkey::int as id, trunc(o_totalprice)::bigint as price,
           strftime(o_orderdate, '%Y-%m-%d') as day, left(o_orderpriority, 4) as priority,
           (o_orderkey % 2 = 0) as even
    from orders
    """
)
def bind_to_target(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) as a",
        "o_totalprice as b",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') as c",
        "o_orderpriority as d",
        "if(o_orderkey % 2 = 0, 'true', 'FALSE') as e",
    )
    target = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("price", T.LongType()),
            T.StructField("day", T.DateType()),
            T.StructField("priority", T.StringType()),
            T.StructField("even", T.BooleanType()),
        ]
    )
    bound = targets.bind_to_target(rows, target, {"priority": 4})
    return bound.withColumn("day", F.col("day").cast("string"))


@check(
    """
    select c_custkey, case when c_custkey % 5 in (0, 1, 2) then null else c_name end as c_name,
           c_mktsegment
    from customer
    """
)
def null_tokens(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        """case c_custkey % 5 when 0 then '' when 1 then '""' when 2 then 'nUlL' else c_name end as c_name""",
        "c_mktsegment",
    )
    return targets.null_tokens(rows)


@check(
    """
    select event_id, coalesce(epoch_ms(date_trunc('second', case when event_id % 3 <> 0 then ts end)), 0) as ts,
           coalesce(case when event_id % 4 <> 0 then value end, 'nan'::double) as value,
           coalesce(case when event_id % 5 <> 0 then event_type end, '') as event_type,
           (case when event_id % 2 = 0 then 1 else 0 end)::bigint as even
    from events
    """
)
def export_orc_legacy(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "case when event_id % 3 <> 0 then ts end as ts",
        "case when event_id % 4 <> 0 then value end as value",
        "case when event_id % 5 <> 0 then event_type end as event_type",
        "event_id % 2 = 0 as even",
    )
    path = scratch_path(spark, "orc")
    with session_setting(spark, "spark.sql.session.timeZone", "UTC"):
        export_orc(rows, path, legacy_nulls=True)
    return spark.read.schema(legacy_orc(rows).schema).orc(path)
