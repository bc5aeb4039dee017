import __spark_entry__ as E
from laborlake.plans.catalog import QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 25
    assert "total_labor_hours" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def test_small_queries_run(spark):
    for name in ["report_top_effort", "report_above_avg_departments", "validation_report_counts"]:
        assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
