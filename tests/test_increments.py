"""Increments against the full recomputation, and R7 over tables bucketed alike."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from laborlake.operators import gold, quality, reports, silver
from laborlake.plans.increments import Increments
from laborlake.schemas import CONTENT_SCHEMA, LABOR_RECORD_SCHEMA
from laborlake.sinks import warehouse

KINDS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTENT_SCHEMA.fields) + ", ingest_seq bigint"


@pytest.fixture
def tmp():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def _events(seed, n=400):
    """Deliveries of 60 keys: null keys and departments, hours that break the rules, one key that holds a third."""
    r = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if r.random() < 0.33 else r.choice([None, *[f"k{i}" for i in range(60)]])
        rows.append((key, r.choice([" t ", "u", None]), r.choice(["film", "Serial", None]), r.choice(["us", " eu"]),
                     r.choice(["Edit", " Sound ", None]), r.choice([None, -1, 0, 7, 51, 101, 5000 + seq]), "2024-01-01T00:00:00Z", "e", seq))
    r.shuffle(rows)
    return rows


def _rows(df):
    return sorted(map(str, df.drop("summary_date").collect()))


def _expected(spark, rows):
    raw = spark.createDataFrame(rows, KINDS)
    clean = silver.build_silver(raw)
    ok = quality.split_by_rules(clean, quality.content_rules())[0]
    return raw, clean.drop("processed_at"), gold.gold_frames(gold.group_state(ok)), gold.group_state(ok)


@pytest.mark.parametrize("compacted", [False, True])
def test_three_batches_equal_the_full_recompute(spark, tmp, compacted):
    rows = _events(5)
    held = Increments(spark, tmp, ["ingest_seq"])
    for b, part in enumerate([rows[:150], rows[150:300], [], rows[300:]]):
        assert held.add(spark.createDataFrame(part, KINDS), b)
        if compacted and b != 2:
            held.compact()
        if b in (1, 3):
            raw, clean, frames, state = _expected(spark, rows[:300 if b == 1 else 400])
            assert _rows(gold.state_from_support(held.support()).select(*state.columns)) == _rows(state)
            assert quality.validate(raw, report=held.report()) == quality.validate(raw)
    assert _rows(held.silver().drop("processed_at")) == _rows(clean)
    got = held.gold()
    assert all(_rows(got[n]) == _rows(frames[n]) for n in frames)


def test_an_earlier_delivery_takes_the_largest_hours_back(spark, tmp):
    held = Increments(spark, tmp, ["ingest_seq"])
    event = lambda key, hours, seq: (key, "t", "film", "us", "Edit", hours, None, None, seq)
    held.add(spark.createDataFrame([event("a", 900, 5), event("b", 60, 6)], KINDS), 0)
    most = lambda: gold.labor_by_department_from_state(gold.state_from_support(held.support())).first()
    assert (most()["max_labor_hours"], most()["total_projects"]) == (900, 2)
    held.add(spark.createDataFrame([event("a", 10, 1), event("b", 999, 7)], KINDS), 1)
    assert (most()["max_labor_hours"], most()["total_labor_hours"], most()["total_projects"]) == (60, 70, 2)
    assert held.report().first()["duplicate_count"] == 2


def test_a_failed_batch_counts_once(spark, tmp):
    held = Increments(spark, tmp, ["ingest_seq"])
    rows = _events(7, 90)
    held.add(spark.createDataFrame(rows[:40], KINDS), 0)
    before = _rows(held.support())
    lost = F.when(F.col("ingest_seq") == rows[60][-1], F.raise_error(F.lit("lost"))).otherwise(F.col("title"))
    with pytest.raises(Exception, match="lost"):
        held.add(spark.createDataFrame(rows[40:], KINDS).withColumn("title", lost.cast("string")), 1)
    assert _rows(held.support()) == before and held.batches() == [0]
    assert held.add(spark.createDataFrame(rows[40:], KINDS), 1)
    assert not held.add(spark.createDataFrame(rows[40:], KINDS), 1)  # delivered again: committed already
    raw, _, _, state = _expected(spark, rows)
    assert _rows(gold.state_from_support(held.support()).select(*state.columns)) == _rows(state)
    assert quality.validate(raw, report=held.report()) == quality.validate(raw)
    with pytest.raises(ValueError, match="comes after"):
        held.add(raw, -1)
    with pytest.raises(quality.ValidationError, match="Missing columns"):
        held.add(raw.drop("title"), 2)


def test_variance_over_bucketed_tables_has_no_shuffle_under_the_join(spark, tmp):
    content = spark.createDataFrame([(f"k{i}", "t", "d", i) for i in range(300)], "content_id string, title string, department string, labor_hours int")
    logs = [("w", "d", "k1" if i % 3 == 0 else f"k{i % 250 + 20}", 1.5, "w", "r") for i in range(900)]
    logs = spark.createDataFrame(logs, LABOR_RECORD_SCHEMA)
    made = warehouse.bucket_for_variance(content, logs, tmp, "bucketed_", rows_per_bucket=50)
    got = reports.hours_variance_from_sums(made[0].hint("merge"), made[1])
    assert _rows(got) == _rows(reports.hours_variance(content, logs))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]  # as run
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert "Exchange" not in plan[plan.index("SortMergeJoin"):]
    assert [warehouse.buckets_for(n, 10) for n in (0, 10, 11, 30, 41)] == [1, 1, 2, 4, 8]
