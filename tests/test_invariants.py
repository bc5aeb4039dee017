"""Whole-table invariants on the driver tables (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from laborlake.operators import gold, reports
from laborlake.operators.quality import validate
from laborlake.operators.silver import build_silver, clean
from laborlake.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return tables.content_events_raw(spark, SF)


def test_raw_rows_split_into_silver_duplicates_and_null_drops(spark, raw):
    _, report = validate(raw)
    dedup_rows = report["total_rows"] - report["duplicate_count"]
    silver_rows = build_silver(raw).count()
    from laborlake.operators.dedup import keep_first
    null_dropped = keep_first(raw, ["content_id"], ["ingest_seq"]).where(F.col("department").isNull()).count()
    assert silver_rows == dedup_rows - null_dropped
    assert clean(raw).count() == silver_rows


def test_gold_totals_equal_silver_total(spark, raw):
    s = build_silver(raw)
    total = s.agg(F.sum("labor_hours")).first()[0]
    assert gold.department_summary(s).agg(F.sum("total_hours")).first()[0] == total
    assert reports.labor_by_department(s).agg(F.sum("total_labor_hours")).first()[0] == total
    assert reports.monthly_throughput(s).agg(F.sum("total_hours")).first()[0] == total


def test_percentages_sum_to_100(spark, raw):
    pct = reports.labor_flag_distribution(build_silver(raw)).agg(F.sum("percentage")).first()[0]
    assert abs(pct - 100.0) < 0.05


def test_variance_rows_one_per_content(spark):
    s = tables.content_events(spark, SF)
    v = reports.hours_variance(s, tables.labor_records(spark, SF))
    assert v.count() == s.count()
    assert v.where(F.col("actual_logged_hours").isNull()).count() == 27


def test_preview_columns(spark):
    assert reports.silver_preview(tables.content_events(spark, SF)).columns == [
        "content_id", "title", "category", "department", "labor_hours", "labor_flag", "region"]


def test_pipeline_csv_export(spark, tmp_path):
    from laborlake.plans.etl_run import run_pipeline
    from laborlake.sinks.lake import Lake
    from laborlake.sources.files import ingest_folder
    root = f"/tmp/{tmp_path.name}-lake"
    out = run_pipeline(spark, tables.content_events_raw(spark, SF), Lake(spark, root), strict=False,
                       csv_export=f"{root}/export")
    back = ingest_folder(spark, out["paths"]["csv"])
    assert back.count() == Lake(spark, root).read_layer("silver", "content_events_clean").count()
