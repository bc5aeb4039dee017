import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from laborlake.operators.silver import build_silver, transform_content_events
from laborlake.plans.monitor import RunEvents, run_summary
from laborlake.plans.etl_run import SourceConfig, extract, run_pipeline
from laborlake.operators.quality import ValidationError
from laborlake.sinks.lake import Lake
from laborlake.sinks.warehouse import create_tables, insert
from laborlake.sources.topic import read_topic
from laborlake.streaming.ingest import read_bronze, start_bronze_ingest, start_silver_stream


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _event(cid, hours, ts, dept="D", title="t"):
    return json.dumps({"content_id": cid, "title": title, "category": "movie", "region": " us ", "department": dept,
                       "labor_hours": hours, "timestamp": ts, "event_type": "content_published"})


def _land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    tmpf = os.path.join(path, "." + name)
    with open(tmpf, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(tmpf, os.path.join(path, name))
    time.sleep(0.05)


def test_stream_dedup_across_batches_and_restart(spark, tmp):
    src, out, chk = f"{tmp}/topic", f"{tmp}/silver", f"{tmp}/chk"
    _land(src, "b0.json", [_event("A", 120, "2024-01-01T00:00:00Z"), _event("B", 60, "2024-01-02T00:00:00Z")])
    _land(src, "b1.json", [_event("A", 999, "2024-01-03T00:00:00Z", title="dup"), "{bad"])
    q = start_silver_stream(read_topic(spark, src, streaming=True, max_files_per_trigger=1), out, chk, "1 hour")
    q.awaitTermination()
    rows = {r.content_id: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"A", "B"} and rows["A"].labor_hours == 120 and rows["A"].region == "US"
    # restart from the checkpoint: only the new file is read, A is still remembered
    _land(src, "b2.json", [_event("A", 5, "2024-01-04T00:00:00Z"), _event("C", 10, "2024-01-04T00:00:00Z")])
    q = start_silver_stream(read_topic(spark, src, streaming=True, max_files_per_trigger=1), out, chk, "1 hour")
    q.awaitTermination()
    got = sorted((r.content_id, r.labor_hours) for r in spark.read.parquet(out).collect())
    assert got == [("A", 120), ("B", 60), ("C", 10)]


def test_stream_equals_batch_without_late_data(spark, tmp):
    src = f"{tmp}/topic"
    lines = [_event(f"K{i}", i * 7 % 150, f"2024-01-{1 + i % 28:02d}T00:00:00Z") for i in range(40)]
    _land(src, "b0.json", lines)
    q = start_silver_stream(read_topic(spark, src, streaming=True), f"{tmp}/s", f"{tmp}/c", "1 hour")
    q.awaitTermination()
    stream = spark.read.parquet(f"{tmp}/s").select("content_id", "labor_flag", "region", "event_timestamp")
    batch_src = read_topic(spark, src).select(F.from_json("value", "content_id string, title string, category string, "
                                                          "region string, department string, labor_hours int, "
                                                          "timestamp string, event_type string").alias("m")).select("m.*")
    batch = transform_content_events(batch_src).select("content_id", "labor_flag", "region", "event_timestamp")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_bronze_stream_and_dead_letters(spark, tmp):
    src = f"{tmp}/topic"
    _land(src, "b0.json", [_event("A", 1, "2024-01-01T00:00:00Z"), "{bad", '{"k": 1}'])
    q = start_bronze_ingest(read_topic(spark, src, streaming=True), f"{tmp}/bronze", f"{tmp}/chk")
    q.awaitTermination()
    assert read_bronze(spark, f"{tmp}/bronze").count() == 1
    assert sorted(r.value for r in read_bronze(spark, f"{tmp}/bronze", dead=True).collect()) == ['{"k": 1}', "{bad"]


def test_lake_region_null_and_na(spark, tmp, sample_events):
    lake = Lake(spark, tmp)
    df = build_silver(sample_events).withColumn(
        "region", F.when(F.col("content_id").endswith("1"), None)
        .when(F.col("content_id").endswith("2"), "NA").otherwise(F.col("region")))
    lake.write_silver(df, "content")
    back = {r.content_id: r.region for r in lake.read_layer("silver", "content").collect()}
    assert back["K-01"] is None and back["K-02"] == "NA"
    with pytest.raises(FileNotFoundError):
        lake.read_layer("gold", "missing")


def test_lake_bronze_append_and_inventory(spark, tmp, sample_events):
    lake = Lake(spark, tmp)
    lake.write_bronze(sample_events, "content_events")
    lake.write_bronze(sample_events, "content_events")
    assert lake.read_layer("bronze", "content_events").count() == 10
    inv = {(r.layer, r.dataset): r.file_count for r in lake.inventory().collect()}
    assert inv[("bronze", "content_events")] >= 2


def test_warehouse_ddl_defaults(spark, tmp, sample_events):
    create_tables(spark, f"{tmp}/wh", "defaults_")
    s = build_silver(sample_events).drop("processed_at", "pipeline_layer")
    insert(spark, "defaults_silver.content_events_clean", s)
    rows = spark.table("defaults_silver.content_events_clean").collect()
    assert len(rows) == 5 and {r.pipeline_layer for r in rows} == {"silver"}
    assert all(r.processed_at is not None for r in rows)


def test_run_events_are_typed(spark, tmp):
    with pytest.raises(KeyError), RunEvents(spark, "nightly", f"{tmp}/ops") as events:
        events.record("STAGE", "Extract", "SUCCESS", 12)
        events.record("WARNING", message="two rows look odd")
        raise KeyError("gone")
    rows = spark.read.parquet(f"{tmp}/ops")
    assert [(r.event_type, r.stage, r.rows) for r in rows.where("stage is not null").collect()] == [("STAGE", "Extract", 12)]
    assert rows.where("seconds >= 0").count() == 4 and "gone" in rows.where("event_type = 'ERROR'").first().message
    s = run_summary(rows).first()
    assert (s.total_events, s.errors, s.warnings) == (4, 1, 1)


def test_pipeline_strict_raises_and_logs(spark, tmp, sample_events):
    bad = sample_events.withColumn("department", F.when(F.col("content_id").endswith("1"), None)
                                   .otherwise(F.col("department")))
    lake = Lake(spark, tmp)
    with pytest.raises(ValidationError):
        run_pipeline(spark, bad, lake, strict=True)
    ev = spark.read.parquet(f"{tmp}/ops/run_events")
    assert ev.where("event_type = 'VALIDATION' and status = 'FAILED'").count() == 1
    assert ev.where(F.col("event_type") == "ERROR").count() == 1


def test_pipeline_end_to_end(spark, tmp, sample_events):
    lake = Lake(spark, tmp)
    out = run_pipeline(spark, sample_events, lake)
    dept = [tuple(r) for r in lake.read_layer("gold", "department_summary").orderBy("department").collect()]
    assert dept[0] == ("Edit", 2, 201, 100.5, 1)
    assert lake.read_layer("silver", "content_events_clean").count() == 5
    assert out["report"]["passed"] and not os.listdir(f"{tmp}/_staging")


def test_second_source_on_one_lake(spark, tmp):
    """A topic run with bad messages and hours, then a file run with text ids and a column more."""
    _land(f"{tmp}/topic", "b0.json", [_event("A", 120, "2024-01-01T00:00:00Z"), _event("B", "ten", "2024-01-01T00:00:00Z"),
                                      _event("C", 100.5, "2024-01-01T00:00:00Z"), "{bad", _event(None, 5, "2024-01-01T00:00:00Z")])
    os.makedirs(f"{tmp}/csv")
    open(f"{tmp}/csv/x.csv", "w").write("content_id,title,category,department,labor_hours,region,release_year\n001,t,c,d,7,r,1990\n")
    lake = Lake(spark, f"{tmp}/lake")
    with pytest.raises(ValidationError, match="content_id"):
        run_pipeline(spark, "kafka", lake, SourceConfig(topic_path=f"{tmp}/topic"))
    out = run_pipeline(spark, "kafka", lake, SourceConfig(topic_path=f"{tmp}/topic"), strict=False)
    assert out["report"]["total_rows"] == 4 and out["report"]["unparsed_hours"] == 2
    assert [r.content_id for r in lake.read_layer("silver", "content_events_clean").collect()] == ["A"]
    bad = {r.content_id: (r.labor_hours_text, r.violations) for r in lake.read_layer("silver", "content_events_quarantine").collect()}
    assert bad == {"B": ("ten", ["labor_hours_type"]), "C": ("100.5", ["labor_hours_type"])}
    run_pipeline(spark, "file", lake, SourceConfig(csv_path=f"{tmp}/csv"))
    row = lake.read_layer("silver", "content_events_clean").first()
    assert (row.content_id, row.labor_hours) == ("001", 7)
    assert lake.read_bronze("content_events").where("release_year = 1990").count() == 1
    assert lake.read_layer("bronze", "dead_letters").select("value").distinct().count() == 1


def test_extract_router(spark, tmp):
    with pytest.raises(ValueError, match="Unsupported source"):
        extract(spark, "ftp", SourceConfig())
    os.makedirs(f"{tmp}/csv")
    open(f"{tmp}/csv/legacy.csv", "w").write(
        "content_id,title,category,department,labor_hours,region,release_year,status\n"
        "OLD-9,Stone Bridge,Feature,Edit,300,south,1992,archived\n")
    df = extract(spark, "file", SourceConfig(csv_path=f"{tmp}/csv"))
    r = df.first()
    assert r.labor_hours == 300 and r.release_year == 1992 and r.source_file == "legacy.csv"


def test_exact_silver_corrects_earlier_answers(spark, tmp):
    """Newest files first: every batch but the last gives answers that a later one corrects; compaction changes nothing."""
    from laborlake.streaming.ingest import compact_exact_silver, read_exact_silver, start_exact_silver

    src, out = f"{tmp}/topic", f"{tmp}/silver"
    for i in range(4):
        _land(src, f"b{i}.json", [_event(f"K{k}", 10 * i + k, "2024-01-01T00:00:00Z") for k in range(i, 6)] + [_event("K5", 99, "2024-01-01T00:00:00Z")])

    def run():
        start_exact_silver(read_topic(spark, src, streaming=True, max_files_per_trigger=1, latest_first=True), out, f"{tmp}/chk").awaitTermination()
        return sorted((r.content_id, r.labor_hours) for r in read_exact_silver(spark, out).collect())

    want = [(f"K{k}", k) for k in range(6)]
    assert run() == want
    assert len(os.listdir(f"{out}/batches")) >= 4
    compact_exact_silver(spark, out)
    assert sum(n.startswith("batch_id=") for n in os.listdir(f"{out}/batches")) == 1
    assert sorted((r.content_id, r.labor_hours) for r in read_exact_silver(spark, out).collect()) == want
    _land(src, "b9.json", [_event("K0", 7, "2024-01-01T00:00:00Z"), _event("NEW", 1, "2024-01-01T00:00:00Z")])
    assert run() == sorted([*want, ("NEW", 1)])
    compact_exact_silver(spark, out)
    assert sorted((r.content_id, r.labor_hours) for r in read_exact_silver(spark, out).collect()) == sorted([*want, ("NEW", 1)])


def test_stream_ends_when_the_topic_is_silent(spark, tmp):
    """A landing during the run is read; after the idle time the stream stops by itself. Its run events are per batch."""
    from laborlake.streaming.ingest import stop_when_idle

    src = f"{tmp}/topic"
    _land(src, "b0.json", [_event("A", 1, "2024-01-01T00:00:00Z"), "{bad"])
    q = start_bronze_ingest(read_topic(spark, src, streaming=True), f"{tmp}/bronze", f"{tmp}/chk", available_now=False, interval="200 milliseconds",
                            events_path=f"{tmp}/events", run_id="R")
    began = time.monotonic()
    while q.lastProgress is None and time.monotonic() - began < 60:
        time.sleep(0.2)
    _land(src, "b1.json", [_event("B", 1, "2024-01-01T00:00:00Z")])
    stop_when_idle(q, idle_seconds=4)
    assert not q.isActive and read_bronze(spark, f"{tmp}/bronze").count() == 2
    rows = {(r.batch_id, r.stage): r.rows for r in spark.read.parquet(f"{tmp}/events").collect()}
    assert {k: v for k, v in rows.items() if v} == {(0, "Extract"): 2, (0, "DeadLetters"): 1, (1, "Extract"): 1}
