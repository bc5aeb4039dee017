"""Structured Streaming plans: topic -> bronze (T-S1), topic -> silver (T-S2..T-S4), and silver with exact first deliveries (T-S3).

Both are bounded with ``trigger(availableNow=True)`` when ``available_now`` is set
(drain what is there, then stop) and resume from their checkpoint on restart.
Checkpoints and sinks must be on the shared file system (the scratch root on a
cluster is ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laborlake.operators.dedup import keep_first
from laborlake.operators.silver import event_columns
from laborlake.plans.monitor import batch_events
from laborlake.schemas import HOURS_TEXT
from laborlake.session import drop_path, list_names
from laborlake.sinks.lake import Lake
from laborlake.sources.topic import CORRUPT, decode_events, is_dead, split_dead_letters

ARRIVAL = ["arrival_part", "arrival_block", "arrival_pos"]


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def start_bronze_ingest(messages: DataFrame, bronze_path: str, checkpoint: str,
                        source_system: str = "topic", available_now: bool = True,
                        interval: str = "30 seconds", events_path: str | None = None,
                        run_id: str | None = None) -> StreamingQuery:
    """T-S1: decode each micro-batch once and write it once; ``dead=true`` holds its dead letters.

    Each batch writes under ``batch_id=<id>`` with dynamic overwrite, so a batch
    replayed after a failure replaces its own output (idempotent sink). With ``events_path`` its run events (M1: rows and dead
    letters, observed by the write itself) are written likewise, once per batch id of ``run_id``.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("arrival_pos", F.coalesce("arrival_pos", F.monotonically_increasing_id()))
        decoded = decode_events(placed)
        stamp = [F.lit(source_system).alias("source_system"), F.current_timestamp().alias("ingested_at"),
                 F.lit(batch_id).cast("bigint").alias("batch_id"), is_dead().alias("dead")]
        seen = Observation()
        out = decoded.select("*", *stamp).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("dead").alias("dead"))
        _overwrite_batch(out, bronze_path, "batch_id", "dead")
        if events_path is not None:
            found = batch_events(batch.sparkSession, run_id or checkpoint, source_system, batch_id, seen.get["rows"] or 0, seen.get["dead"] or 0)
            _overwrite_batch(found, events_path, "run_id", "batch_id")

    w = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def _overwrite_batch(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_bronze(spark: SparkSession, bronze_path: str, dead: bool = False) -> DataFrame:
    """The good events (or the dead letters) of the bronze stream."""
    rows = spark.read.parquet(bronze_path).where(F.col("dead") == dead).drop("dead")
    return rows if dead else rows.drop(CORRUPT, "value")


def silver_stream(messages: DataFrame, redelivery_window: str) -> DataFrame:
    """T-S2 + T-S3: decode, X1 column functions, de-duplicate content_id within the arrival watermark.

    ``redelivery_window`` bounds the state: later re-deliveries are not recognised, and of deliveries
    within one micro-batch any may stay. The exact path is the bronze stream with silver rebuilt from it.
    """
    good, _ = split_dead_letters(decode_events(messages))
    return (event_columns(good.drop(HOURS_TEXT))
            .withWatermark("arrived_at", redelivery_window)
            .dropDuplicatesWithinWatermark(["content_id"]))


def start_silver_stream(messages: DataFrame, silver_path: str, checkpoint: str,
                        redelivery_window: str, available_now: bool = True,
                        interval: str = "30 seconds") -> StreamingQuery:
    """T-S4: append silver rows as parquet partitioned by region."""
    w = (silver_stream(messages, redelivery_window).writeStream.format("parquet")
         .partitionBy("region").option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, interval).start(silver_path)


# ---- T-S3 with exact first deliveries --------------------------------------------------------------

def start_exact_silver(messages: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                       interval: str = "30 seconds") -> StreamingQuery:
    """T-S3: the first delivery of every key, whatever batches its deliveries come in, and in whatever order.

    Each micro-batch keeps its own first row per key (a partial aggregate) and appends it under its batch id; ``read_exact_silver``
    takes the smallest arrival over the batches, so a later batch with an earlier delivery corrects the answer. The
    state is on storage and needs no watermark; ``compact_exact_silver`` merges it, so it holds one row a key.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("arrival_pos", F.coalesce("arrival_pos", F.monotonically_increasing_id()))
        good, _ = split_dead_letters(decode_events(placed))
        firsts = keep_first(event_columns(good.drop(HOURS_TEXT, "arrived_at")), ["content_id"], ARRIVAL)
        _overwrite_batch(firsts.withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{path}/batches", "batch_id")

    w = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def _held(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the merged state, if there is one, and of the batches; a batch that is in both does no harm."""
    merged, names = Lake(spark, path).current("silver", "merged"), list_names(spark, f"{path}/batches")
    frames = [spark.read.parquet(merged)] if merged else []
    if any(n.startswith("batch_id=") for n in names):
        frames.append(spark.read.parquet(f"{path}/batches"))
    if not frames:
        raise FileNotFoundError(path)
    out = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return keep_first(out, ["content_id"], ARRIVAL)


def read_exact_silver(spark: SparkSession, path: str) -> DataFrame:
    """One row per key, its first delivery among all batches so far."""
    return _held(spark, path).drop("batch_id", *ARRIVAL)


def compact_exact_silver(spark: SparkSession, path: str) -> str:
    """Publish the merged state as a new version, then drop the batches that went into it; safe beside a running stream."""
    names = [n for n in list_names(spark, f"{path}/batches") if n.startswith("batch_id=")]
    out = Lake(spark, path).write_silver(_held(spark, path), "merged", partition_by=())
    for name in names[:-1]:  # the newest one may be written anew after a failure
        drop_path(spark, f"{path}/batches/{name}")
    return out


def stop_when_idle(query: StreamingQuery, idle_seconds: float = 5.0, poll_seconds: float = 0.25) -> None:
    """Wait until a running stream has read nothing for ``idle_seconds``, then stop it; errors of the stream are raised."""
    last, batch = time.monotonic(), None
    while not query.awaitTermination(poll_seconds):
        progress, status = query.lastProgress, query.status
        now = (progress["batchId"], progress["numInputRows"]) if progress else None
        if status["isTriggerActive"] and status["isDataAvailable"] or now != batch and now is not None and now[1] > 0:
            last = time.monotonic()
        batch = now
        if time.monotonic() - last > idle_seconds:
            query.stop()
            return
