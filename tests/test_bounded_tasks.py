"""What one task holds does not grow with the tables: partitions, files, splits and groups of bounded size."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from laborlake import session
from laborlake.operators.silver import transform_content_events
from laborlake.plans import catalog
from laborlake.sinks import warehouse
from laborlake.sinks.lake import Lake
from laborlake.sources import tables


@pytest.fixture
def star(spark, monkeypatch):
    """Tables of 400 orders with four line items each, and partitions of 50 rows."""
    monkeypatch.setattr(tables, "ROWS_PER_PART", 50)
    day, out = dt.datetime(2024, 1, 1), tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = {
        "region": [(0, "ASIA")], "nation": [(0, "INDIA", 0)],
        "customer": [(c, f"Customer {c}", 0, 1.0, "BUILDING") for c in range(20)],
        "orders": [(k, k % 20, "F", 1000.0 * k, day, "1-URGENT") for k in range(1, 401)],
        "lineitem": [(k, 1, 1, n, 1.0, 1.0, 0.0, 0.0, "R", "F", day) for k in range(1, 401) for n in range(1, 5)],
        "events": [(e, day, 1, "view", 1.0, '{"a": 1}') for e in range(30)],
    }
    for name, of in rows.items():
        spark.createDataFrame(of, tables.SCHEMAS[name]).write.parquet(f"{out}/{name}.parquet")
    return out


def test_raw_events_come_in_bounded_partitions_a_key_in_one(spark, star):
    raw = tables.content_events_raw(spark, star)
    got = raw.select("content_id", F.spark_partition_id().alias("p"))
    assert raw.count() == 2000
    assert got.groupBy("content_id").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0
    assert got.groupBy("p").count().agg(F.max("count")).first()[0] < 300
    assert tables.delivery_parts(spark, star) == 40


def test_first_deliveries_need_no_second_sort_of_the_wide_rows(spark, star):
    first = transform_content_events(tables.content_events_raw(spark, star))
    plan = first._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    above = plan[:plan.index("SortMergeJoin")]
    assert "SortAggregate" in above and "Exchange" not in above and "Sort [" not in above
    assert first.count() == 400 and first.where("ingest_seq <> 0").count() == 0


def test_landed_topics_grow_in_files(spark, star):
    path = catalog._land_by_key(spark, star, session.fresh_path(spark, "landing", "t"))
    read = spark.read.text(path).select(F.get_json_object("value", "$.content_id").alias("k"), F.input_file_name().alias("f"))
    assert read.count() == 2000 and len(spark.read.text(path).inputFiles()) > 30
    assert read.groupBy("k").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
    src, first_files = catalog._land_topic(spark, star)
    held = spark.read.text(src).groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("count")).first()
    assert held[0] <= 50 and first_files >= 8 and spark.read.text(src).count() == 2000


def test_stages_read_small_splits(spark, monkeypatch):
    monkeypatch.setattr(session, "_SPLIT", 1000)
    root, own = tempfile.mkdtemp(prefix="run-", dir="/tmp"), spark.conf.get(session._SPLIT_KEY)
    with open(f"{root}/lines.txt", "w") as f:
        f.write("a line of text\n" * 2000)
    staged = Lake(spark, f"{root}/lake").stage(spark.read.text(f"{root}/lines.txt"), "R", "lines")
    assert staged.count() == 2000 and len(staged.inputFiles()) > 20
    assert spark.conf.get(session._SPLIT_KEY) == own
    with pytest.raises(ZeroDivisionError), session.small_splits(spark):
        assert spark.conf.get(session._SPLIT_KEY) == "1000"
        raise ZeroDivisionError
    assert spark.conf.get(session._SPLIT_KEY) == own


def test_log_ids_read_their_records_once(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "_BUCKET", 100)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("employee_id"), F.lit(None).cast("string").alias("role"))
    keyed = warehouse.with_log_id(rows.unionByName(rows))
    assert all("/staging/log_ids/" in f for f in keyed.inputFiles()) and keyed.inputFiles()
    assert sorted(r.log_id for r in keyed.collect()) == list(range(1, 2001))
