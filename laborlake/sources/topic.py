"""Content-event topic source (S1) and message decoding with dead letters.

``read_topic`` gives a frame with a string ``value`` plus arrival-order columns,
from Kafka (``format="kafka"``; needs the Kafka connector on the classpath) or
from its offline twin, a folder of JSON-lines files (``format="text"``). Both
the batch and the streaming forms share the same decoding.

Kafka: earliest offsets; a batch read covers earliest..latest (the reference's
full re-read); a stream with a checkpoint resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlake.functions.expressions import conform_content
from laborlake.schemas import HOURS_TEXT, MESSAGE_SCHEMA

CORRUPT = "_corrupt_record"
_DECODE_SCHEMA = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_topic(spark: SparkSession, source: str, fmt: str = "text", topic: str | None = None,
               streaming: bool = False, max_files_per_trigger: int | None = None,
               latest_first: bool = False) -> DataFrame:
    """Raw messages: ``value`` STRING, ``arrived_at`` TIMESTAMP, and their arrival order:
    ``arrival_part`` STRING, ``arrival_block`` BIGINT, ``arrival_pos`` BIGINT.

    Kafka: partition and offset (producer clocks are not ordered, so the time takes no part). File twin:
    file time and path, block, and the row's place in the block; a stream has no such place, its
    micro-batches get one where they are written. ``latest_first``: a stream takes the newest files first.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        df = (reader.format("kafka")
              .option("kafka.bootstrap.servers", source)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest")
              .load())
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("partition").cast("string").alias("arrival_part"),
                         F.lit(0).cast("bigint").alias("arrival_block"),
                         F.col("offset").alias("arrival_pos"),
                         F.col("timestamp").alias("arrived_at"))
    r = reader.format("text")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if streaming and latest_first:
        r = r.option("latestFirst", True)
    df = r.load(source)
    # File twin: a file is a partition of the topic; the file time is the arrival time.
    at = F.col("_metadata.file_modification_time")
    return df.select("value",
                     F.concat_ws(" ", F.date_format(at, "yyyyMMddHHmmssSSS"), F.col("_metadata.file_path")).alias("arrival_part"),
                     F.col("_metadata.file_block_start").alias("arrival_block"),
                     (F.lit(None).cast("bigint") if streaming else F.monotonically_increasing_id()).alias("arrival_pos"),
                     at.alias("arrived_at"))


def decode_events(messages: DataFrame, failfast: bool = False) -> DataFrame:
    """JSON ``value`` -> content-event columns + ``_corrupt_record``.

    PERMISSIVE (default): bad JSON keeps its text in ``_corrupt_record``; a null
    value gives all-null fields. ``failfast`` raises on the first bad message,
    like the reference's deserializer.
    """
    opts = {"mode": "FAILFAST"} if failfast else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    schema = MESSAGE_SCHEMA if failfast else _DECODE_SCHEMA
    rest = [c for c in messages.columns if c != "value"]
    # The parse is a generator (inline of a one-element array), so it runs once per
    # message: filters and projections on its fields cannot re-inline from_json.
    parsed = conform_content(messages.select(*rest, "value", F.inline_outer(F.array(F.from_json(F.col("value"), schema, opts)))))
    fields = [F.col(f.name) for f in MESSAGE_SCHEMA.fields] + [F.col(HOURS_TEXT)]
    corrupt = (F.coalesce(F.col(CORRUPT), F.when(F.col("value").isNull(), F.lit("<null message>")))
               if not failfast else F.lit(None).cast("string"))
    return parsed.select(*fields, *rest, F.col("value"), corrupt.alias(CORRUPT))


def is_dead(null_key: bool = True) -> Column:
    """A decoded message that did not parse or, with ``null_key``, has no content_id."""
    dead = F.col(CORRUPT).isNotNull()
    return dead | F.col("content_id").isNull() if null_key else dead


def split_dead_letters(decoded: DataFrame, null_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good events, dead letters). Good events drop the raw text; dead letters keep ``value`` and ``_corrupt_record``.

    A batch run takes ``null_key=False``: messages that parsed without a key reach the validation.
    """
    dead = is_dead(null_key)
    return decoded.where(~dead).drop(CORRUPT, "value"), decoded.where(dead)


def encode_events(events: DataFrame) -> DataFrame:
    """Content events -> JSON message ``value`` (the producer side; used to land the twin)."""
    cols = [c for c in (f.name for f in MESSAGE_SCHEMA.fields) if c in events.columns]
    return events.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))
