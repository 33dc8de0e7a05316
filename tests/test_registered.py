"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import differences, oracle

from checks import all_queries, all_sql

SF = "/root/testdata/sf0.001"
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


# Results of one row end in a single task.
ONE_ROW = {"count_check", "export_stats", "rowkey_region_splits"}


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, con, name):
    def scalable(plan):
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert name in ONE_ROW or "SinglePartition" not in plan
        assert "Coalesce 1" not in plan
        assert name == "t_custom" or ("Python" not in plan and "Pandas" not in plan)

    assert differences(spark, con, SF, name, all_queries()[name], SQL.get(name), scalable) is None


def test_every_query_has_sql():
    assert set(SQL) == set(all_queries())


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
