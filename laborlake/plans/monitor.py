"""Run metrics (M1, M2): an append-only run-event table with typed columns, and its per-run summary.

A run records a handful of events, buffered on the driver (a few rows per run, never
data) and appended to ``ops/run_events`` once at the end, also when the run
fails. What happened is in ``event_type``, ``stage`` and ``status``; ``rows`` and ``seconds``
are numbers; ``message`` is only for texts that have no column (warnings, errors).
Row counts come from ``DataFrame.observe`` so counting costs no extra job.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from laborlake.schemas import RUN_EVENT_SCHEMA
from laborlake.sinks.lake import new_run_id


class RunEvents:
    """The events of one run; a context manager that notes start, end, failure and duration."""

    def __init__(self, spark: SparkSession, pipeline: str, table_path: str, run_id: str | None = None):
        self.spark, self.pipeline, self.table_path = spark, pipeline, table_path
        self.run_id = run_id or new_run_id()
        self.rows: list[tuple] = []
        self.began = time.monotonic()

    def record(self, event_type: str, stage: str | None = None, status: str | None = None, rows: int | None = None,
               message: str | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
        seconds = round(time.monotonic() - self.began, 2)
        self.rows.append((now, self.run_id, self.pipeline, event_type, stage, status, rows, seconds, message))

    def has(self, event_type: str) -> bool:
        return any(r[3] == event_type for r in self.rows)

    def __enter__(self) -> RunEvents:
        self.record("START")
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is not None and not self.has("ERROR"):
            self.record("ERROR", status="FAILED", message=f"{kind.__name__}: {error}")
        if self.rows:
            (self.spark.createDataFrame(self.rows, RUN_EVENT_SCHEMA)
             .write.mode("append").partitionBy("run_id").parquet(self.table_path))
            self.rows = []


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter evaluated by the next action on ``df`` (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def batch_events(spark: SparkSession, run_id: str, pipeline: str, batch_id: int, rows: int, dead: int) -> DataFrame:
    """M1 for streams: the events of one micro-batch, with its id; two rows, whatever the batch holds."""
    now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    found = [(now, run_id, pipeline, "STAGE", stage, "SUCCESS", n, None, None) for stage, n in (("Extract", rows), ("DeadLetters", dead))]
    return spark.createDataFrame(found, RUN_EVENT_SCHEMA).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def run_summary(events: DataFrame) -> DataFrame:
    """Per run: total events, ERROR events, WARNING events (exact type names only).

    The event list itself is the run's rows of the event table (filter by run_id);
    it is not collected into one value.
    """
    return (events.groupBy("run_id", "pipeline")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_if(F.col("event_type") == "ERROR").alias("errors"),
                 F.count_if(F.col("event_type") == "WARNING").alias("warnings")))
