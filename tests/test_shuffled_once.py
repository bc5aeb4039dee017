"""What a labor-log run shuffles and writes: records once, keys of their own narrow, pages compressed."""

import glob
import gzip
import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.expressions import iso_week
from laborlake.operators import quality
from laborlake.plans import catalog
from laborlake.plans.etl_run import SourceConfig, run_pipeline
from laborlake.sinks import warehouse
from laborlake.sinks.lake import Lake


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("run, copies", [(10_000, 3), (2, 3), (2, 2), (1, 1), (4, 11)])
def test_numbers_need_no_shuffle_of_the_records(spark, monkeypatch, run, copies):
    monkeypatch.setattr(warehouse, "_RUN", run)
    monkeypatch.setattr(warehouse, "_BUCKET", 10)
    record = T.StructType([T.StructField("employee_id", T.StringType()), T.StructField("hours_logged", T.DoubleType())])
    rows = spark.createDataFrame([(None if i % 7 == 0 else f"e{i}", None if i % 5 == 0 else i / 2) for i in range(200)], record)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("hours_logged") < 20, copies).otherwise(1)))).drop("copy")
    for source in (rows, rows.repartition(6, "employee_id"), rows.coalesce(1)):
        keyed = warehouse.with_log_id(source)
        assert sorted(r.log_id for r in keyed.collect()) == list(range(1, rows.count() + 1))
        assert keyed.drop("log_id").exceptAll(rows).count() == rows.exceptAll(keyed.drop("log_id")).count() == 0
    assert warehouse.with_log_id(rows.repartition(3)).exceptAll(warehouse.with_log_id(rows)).count() == 0
    first = [line for line in _plan(warehouse.with_log_id(rows)).split("Union")[1].splitlines() if "Exchange hashpartitioning(" in line]
    assert all("base#" in line or "task#" in line for line in first)  # records with many copies, sums per group


def test_repeated_keys_stand_for_the_window(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", -6), ("a", -7)], "k string, v int")
    rules = [("v_positive", F.col("v") < 0)]
    want = quality.apply_rules(df, rules, key="k")
    got = quality.apply_rules(df, rules, key="k", repeated=quality.repeated_keys(df, "k"))
    assert got.schema == want.schema
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert {(r.k, r.v): r.violations for r in got.collect()}["a", -7] == ["v_positive", "primary_key_unique"]
    assert quality.apply_rules(df, []).select("violations").distinct().collect()[0][0] == []


def test_a_labor_run_sorts_no_record_by_its_key(spark, monkeypatch):
    root, plans = tempfile.mkdtemp(prefix="run-", dir="/tmp"), []
    with open(f"{root}/pages.json", "w") as f:
        row = {"employee_id": "e", "department": "D", "project_id": "p", "hours_logged": 2.0, "week": "2024-W01", "role": "R"}
        f.write(json.dumps({"page": 1, "results": [row, row, {**row, "hours_logged": -1.0}, {**row, "employee_id": None}], "next": None}) + "\n")
    write = Lake.write_silver
    monkeypatch.setattr(Lake, "write_silver", lambda self, df, *a, **k: (plans.append(_plan(df)), write(self, df, *a, **k))[1])
    lake = Lake(spark, f"{root}/lake")
    run_pipeline(spark, "api", lake, SourceConfig(pages_path=f"{root}/pages.json"))
    assert all("hashpartitioning(log_id" not in p.replace(" ", "") for p in plans) and len(plans) == 2
    ok, bad = lake.read_layer("silver", "labor_logs"), lake.read_layer("silver", "labor_logs_quarantine")
    assert sorted(r.hours_logged for r in ok.collect()) == [2.0, 2.0]
    assert sorted(r.violations for r in bad.collect()) == [["employee_id_not_null"], ["hours_logged_non_negative"]]
    assert sorted(r.log_id for r in ok.select("log_id").union(bad.select("log_id")).collect()) == [1, 2, 3, 4]


def test_pages_land_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(catalog, "PAGES_PER_FILE", 3)
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    landed = spark.range(20).coalesce(1).select((F.col("id") + 1).cast("int").alias("page"), F.lit("x").alias("next"))
    files = glob.glob(catalog._write_pages(landed, f"{root}/pages") + "/*.json.gz")
    assert [len(gzip.open(f).read().splitlines()) <= 3 for f in files] == [True] * 7


def test_weeks_as_formatted(spark):
    days = spark.sql("SELECT explode(sequence(date'1998-12-01', date'2006-02-01')) AS d UNION ALL SELECT null")
    thursday = F.date_add("d", 3 - ((F.dayofweek("d") + 5) % 7))
    assert days.where(~iso_week("d").eqNullSafe(F.format_string("%d-W%02d", F.year(thursday), F.weekofyear("d")))).count() == 0
