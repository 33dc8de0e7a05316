"""The incremental summary joins its facts once, not once for each load."""

from __future__ import annotations

import datetime

from checks import pipelines
from rowbridge.plans import pipelines as flows


def test_facts_are_joined_once(spark, tmp_path, monkeypatch):
    tables = {
        "nation": "select 1L as n_nationkey, 'Aland' as n_name",
        "supplier": "select 1L as s_suppkey, 1L as s_nationkey",
        "part": "select 1L as p_partkey, 'PROMO' as p_type, 'b1' as p_brand, 10.0D as p_retailprice",
        "lineitem": "select id as l_orderkey, 1 as l_linenumber, 1L as l_partkey, 1L as l_suppkey, 2.0D as l_quantity,"
        " 0.1D as l_discount, timestamp'1995-06-15' + make_dt_interval(cast(id as int)) as l_shipdate from range(5)",
    }
    for name, query in tables.items():
        spark.sql(query).write.parquet(str(tmp_path / f"{name}.parquet"))
    plans, states = [], flows.summary_states

    def planned(fact, *measures):
        plans.append(fact._jdf.queryExecution().optimizedPlan().toString())
        return states(fact, *measures)

    monkeypatch.setattr(flows, "summary_states", planned)
    got = pipelines.incremental_summary(spark, str(tmp_path)).collect()
    assert [(r["summary_date"], r["total_quantity"]) for r in got] == [(str(datetime.date(1995, 6, 1)), 10)]
    assert len(plans) == 3 and not any("Join" in p for p in plans)
