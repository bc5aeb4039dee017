import pytest

from laborlake.operators import gold, reports
from laborlake.operators.silver import build_silver


@pytest.fixture
def silver(sample_events):
    return build_silver(sample_events)


def _rows(df, key):
    return {key(r): r for r in df.collect()}


def test_flags(silver):
    got = {r.content_id: (r.labor_flag, r.labor_hours) for r in silver.collect()}
    assert got == {"K-01": ("MEDIUM", 51), "K-02": ("HIGH", 101), "K-03": ("LOW", 50), "K-04": ("HIGH", 160), "K-05": ("MEDIUM", 100)}


def test_department_summary(silver):
    got = [tuple(r) for r in gold.department_summary(silver).collect()]
    assert got == [("Edit", 2, 201, 100.5, 1), ("Effects", 1, 160, 160.0, 1), ("Sound", 2, 101, 50.5, 0)]


def test_category_summary(silver):
    got = [tuple(r) for r in gold.category_summary(silver).collect()]
    assert got == [("FEATURE", 3, 251, 83.67), ("SERIAL", 1, 51, 51.0), ("SHORT", 1, 160, 160.0)]


def test_gold_totals_add_up(silver):
    total = sum(r.labor_hours for r in silver.collect())
    assert sum(r.total_hours for r in gold.department_summary(silver).collect()) == total
    assert sum(r.total_labor_hours for r in gold.aggregate_labor_by_department(silver).collect()) == total


def test_a1_a2_columns_and_order(silver):
    a1 = gold.aggregate_labor_by_department(silver)
    assert a1.columns == ["department", "region", "total_labor_hours", "avg_labor_hours", "total_projects",
                          "max_labor_hours"]
    assert [r.total_labor_hours for r in a1.collect()] == [160, 101, 100, 51, 50]
    a2 = gold.aggregate_by_category(silver).collect()
    assert a2[0].category == "FEATURE" and a2[0].total_titles == 3


def test_report1(silver):
    got = [tuple(r) for r in reports.labor_by_department(silver).collect()]
    assert got == [("Effects", "WEST", 1, 160, 160.0, 160, 1), ("Edit", "SOUTH", 1, 101, 101.0, 101, 1),
                   ("Edit", "NORTH", 1, 100, 100.0, 100, 0), ("Sound", "NORTH", 1, 51, 51.0, 51, 0), ("Sound", "SOUTH", 1, 50, 50.0, 50, 0)]


def test_report2(silver):
    got = [tuple(r) for r in reports.category_region_volume(silver).collect()]
    assert got == [("FEATURE", "SOUTH", 2, 151), ("FEATURE", "NORTH", 1, 100), ("SERIAL", "NORTH", 1, 51), ("SHORT", "WEST", 1, 160)]


def test_report3(silver):
    got = {r.labor_flag: (r["count"], r.percentage) for r in reports.labor_flag_distribution(silver).collect()}
    assert got == {"HIGH": (2, 40.0), "MEDIUM": (2, 40.0), "LOW": (1, 20.0)}


def test_report4(silver):
    got = [tuple(r) for r in reports.monthly_throughput(silver.withColumn("processed_at", silver.event_timestamp))
           .collect()]
    assert got == [("2023-11", 2, 152), ("2023-12", 1, 50), ("2024-01", 2, 260)]


def test_report5(silver):
    assert [r.content_id for r in reports.top_effort(silver).collect()] == ["K-04", "K-02", "K-05", "K-01", "K-03"]


def test_report6(silver):
    assert [tuple(r) for r in reports.above_average_departments(silver).collect()] == [("Effects", 160.0), ("Edit", 100.5)]


VARIANCE = {"K-01": 39.0, "K-02": -9.5, "K-03": None, "K-04": 0.0, "K-05": None}


def test_report7(silver, sample_labor):
    assert {r.content_id: r.variance for r in reports.hours_variance(silver, sample_labor).collect()} == VARIANCE


def test_gold_tables(silver):
    t = gold.department_labor_summary_table(silver)
    assert t.columns == ["department", "region", "total_projects", "total_labor_hours", "avg_labor_hours",
                         "high_effort_count", "summary_date"]
    assert gold.category_summary_table(silver).count() == 3


def test_report_over_warehouse_tables(spark, silver, sample_labor, tmp_path):
    from laborlake.sinks.warehouse import create_tables, insert, with_log_id
    create_tables(spark, f"/tmp/{tmp_path.name}-wh", "reports_")
    insert(spark, "reports_silver.content_events_clean", silver, overwrite=True)
    insert(spark, "reports_silver.labor_logs", with_log_id(sample_labor), overwrite=True)
    got = reports.hours_variance(spark.table("reports_silver.content_events_clean"), spark.table("reports_silver.labor_logs"))
    assert {r.content_id: r.variance for r in got.collect()} == VARIANCE
