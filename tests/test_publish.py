import tempfile

import pytest
from pyspark.sql import functions as F

from laborlake.operators import gold
from laborlake.sinks import warehouse
from laborlake.sinks.lake import Lake


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _failing(spark, n):
    """Rows of which the last cannot be made."""
    bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("EU"))
    return spark.range(0, n, 1, 4).select(F.col("id").cast("string").alias("content_id"), bad.cast("string").alias("region"))


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_a_failing_write_leaves_the_old_answer(spark, tmp, layer):
    lake = Lake(spark, tmp)
    write = lake.write_silver if layer == "silver" else lake.write_gold
    write(spark.createDataFrame([("a", "US"), ("b", "EU")], "content_id string, region string"), "d")
    held = lake.read_layer(layer, "d")
    with pytest.raises(Exception, match="lost"):
        write(_failing(spark, 1000), "d")
    assert sorted(r.content_id for r in lake.read_layer(layer, "d").collect()) == ["a", "b"]
    assert lake.inventory().first()["dataset"] == "d" and lake.row_counts().first()["row_count"] == 2
    write(spark.createDataFrame([("c", "US")], "content_id string, region string"), "d")
    assert [r.content_id for r in lake.read_layer(layer, "d").collect()] == ["c"]
    assert held.count() == 2  # a plan from before the publication still has its version
    write(spark.createDataFrame([("e", "US")], "content_id string, region string"), "d")
    assert len(lake.versions(layer, "d")) == 2 and lake.row_counts().first()["row_count"] == 1


def test_dynamic_write_replaces_its_regions_only(spark, tmp):
    lake = Lake(spark, tmp)
    kinds = "content_id string, region string"
    lake.write_silver(spark.createDataFrame([("a", "US"), ("b", "EU"), ("c", None)], kinds), "d")
    lake.write_silver(spark.createDataFrame([("x", "EU"), ("y", None)], kinds), "d", dynamic=True)
    assert sorted((r.content_id, r.region) for r in lake.read_layer("silver", "d").collect()) == [("a", "US"), ("x", "EU"), ("y", None)]


def test_a_failing_table_overwrite_leaves_the_old_rows(spark, tmp):
    warehouse.create_tables(spark, f"{tmp}/wh", "publish_")
    table = "publish_gold.category_summary"
    rows = lambda k, n: spark.createDataFrame([(k, n, n, 1.0)], "category string, total_titles long, total_labor_hours long, avg_labor_hours double")
    for n in (1, 2, 3):
        warehouse.insert(spark, table, rows("a", n), overwrite=True)
        assert [(r.category, r.total_titles) for r in spark.table(table).collect()] == [("a", n)]
    bad = _failing(spark, 50).select(F.col("region").alias("category"), F.lit(1).cast("long").alias("total_titles"))
    with pytest.raises(Exception, match="lost"):
        warehouse.insert(spark, table, bad, overwrite=True)
    assert [(r.category, r.total_titles) for r in spark.table(table).collect()] == [("a", 3)]
    assert spark.table(table).where("summary_date = current_date()").count() == 1
    assert [t.name for t in spark.catalog.listTables("publish_gold")] == ["category_summary", "department_labor_summary"]
    warehouse.insert(spark, table, rows("b", 1))
    assert spark.table(table).count() == 2


def test_log_ids_are_dense(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_RUN", 7)
    monkeypatch.setattr(warehouse, "_BUCKET", 10)
    hot = spark.range(400).select(F.lit("W1").alias("employee_id"), F.lit(None).cast("double").alias("n"))
    rest = spark.range(300).select((F.col("id") % 90).cast("string").alias("employee_id"), (F.col("id") % 3).cast("double").alias("n"))
    rows = hot.unionByName(rest)
    got = warehouse.with_log_id(rows)
    assert got.columns == ["employee_id", "n", "log_id"]
    assert sorted(r.log_id for r in got.collect()) == list(range(1, 701))
    assert got.drop("log_id").exceptAll(rows).count() == rows.exceptAll(got.drop("log_id")).count() == 0
    assert warehouse.with_log_id(rows.repartition(5)).exceptAll(got).count() == 0
    assert warehouse.with_log_id(rows.limit(0)).count() == 0


def test_gold_from_the_group_state(spark):
    kinds = "content_id string, department string, region string, category string, labor_hours int, labor_flag string"
    rows = [("a", "D", "US", "m", 120, "HIGH"), ("b", "D", "US", "s", None, "LOW"), ("c", "D", "EU", "m", 60, "MEDIUM"),
            ("d", "E", None, None, None, "LOW"), ("e", None, "US", "s", 7, "LOW"), (None, "E", None, "s", 101, "HIGH")]
    df = spark.createDataFrame(rows, kinds)
    frames = gold.gold_frames(gold.group_state(df))
    want = {**gold.gold_layer(df), "department_labor_summary": gold.department_labor_summary_table(df),
            "category_summary_table": gold.category_summary_table(df)}
    for name, frame in want.items():
        assert frames[name].schema.simpleString() == frame.schema.simpleString()
        assert sorted(map(tuple, frames[name].collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr)
