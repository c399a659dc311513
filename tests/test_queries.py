"""Every registered query against its SQL."""

import pytest
from parity import spark_rows, sql_rows

import __spark_entry__ as entry_point
from airhour.plans.oracles import ORACLES
from airhour.plans.registry import QUERIES
from airhour.schema import OUTPUT_COLUMNS

SF = "/root/testdata/sf0.001"


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns == OUTPUT_COLUMNS and out.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    df = entry_point.queries()[name](spark, SF)
    assert spark_rows(df) == sql_rows(SF, entry_point.oracle_sql()[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "NestedLoop"):
        assert word not in plan
