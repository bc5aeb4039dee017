"""Silver-layer transforms.

``transform_content_events`` (X1) - the stream-capable transform: parse time,
    upper-case category/region, strip department/title, flag, layer tag, drop the
    raw timestamp, keep the first event per content_id.
``clean`` (X2) - normalize names -> keep first per content_id -> drop rows with a
    null content_id/department -> strip every string column (in that order).
``build_silver`` (X3 body) - X2 followed by the X1 expressions and the run
    metadata: the canonical 12-column silver.content_events_clean.
``transform`` (X3) - validate, raise on failure, then ``build_silver``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlake.functions.expressions import (
    conform_content, labor_flag, normalize_columns, parse_event_time, silver_metadata, strip_string_columns, strip_ws,
    upper_strip,
)
from laborlake.operators.dedup import first_row_agg, keep_first, unpack_first
from laborlake.operators.quality import ValidationError, failure_reason, per_key_counters, validate
from laborlake.schemas import (
    BAD_ENCODING, CRITICAL_COLUMNS, PIPELINE_LAYER, REQUIRED_COLUMNS, RULE_COLUMNS, SILVER_COLUMNS,
)

# Columns that carry arrival order, if the source has them (topic partition/offset, file/position).
INGEST_ORDER = ["ingest_seq", "arrival_part", "arrival_block", "arrival_pos"]


def _order_cols(df: DataFrame, order: Sequence[str] | None) -> list[str]:
    return [c for c in (INGEST_ORDER if order is None else order) if c in df.columns]


def _derived(c: Sequence[str]) -> dict[str, Column]:
    """The silver columns that are computed from a raw event's columns, by name."""
    time = "timestamp" if "timestamp" in c else None
    given = F.col("event_timestamp") if "event_timestamp" in c else F.lit(None).cast("timestamp")
    return {
        "category": upper_strip("category"),
        "region": upper_strip("region"),
        "department": strip_ws("department"),
        "title": strip_ws("title"),
        "event_timestamp": parse_event_time(time) if time else given,
        "labor_flag": labor_flag("labor_hours"),
    }


def event_columns(df: DataFrame) -> DataFrame:
    """The stateless part of X1 (shared by the batch and the streaming silver), as one projection."""
    made = _derived(df.columns)
    kept = [made.pop(c).alias(c) if c in made else F.col(c) for c in df.columns if c != "timestamp"]
    return df.select(*kept, *[x.alias(n) for n, x in made.items()], F.lit(PIPELINE_LAYER).alias("pipeline_layer"))


def transform_content_events(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """X1 on a raw event frame (columns of CONTENT_SCHEMA, optionally ``ingest_seq``)."""
    out = event_columns(df)
    return keep_first(out, ["content_id"], _order_cols(out, order))


def clean(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Rename -> dedup (first) -> drop critical nulls -> strip strings."""
    df = normalize_columns(df)
    df = keep_first(df, ["content_id"], _order_cols(df, order))
    df = df.na.drop(subset=CRITICAL_COLUMNS)
    return strip_string_columns(df)


def group_raw(raw: DataFrame, order: Sequence[str] | None = None,
              required: Sequence[str] = REQUIRED_COLUMNS) -> tuple[DataFrame, list[str], list[str]]:
    """One aggregate per content_id giving both the validation counters and the first row.

    Validation and de-duplication group by the same key, so a run shuffles the
    raw rows once (partially aggregated) instead of twice. Returns the grouped
    frame, the packed column order and the (normalized) raw column names.
    """
    df = conform_content(normalize_columns(raw))
    pick, packed = first_row_agg(df, ["content_id"], _order_cols(df, order))
    grouped = df.groupBy("content_id").agg(*per_key_counters(required, df.columns), pick)
    return grouped, packed, df.columns


def silver_from_grouped(grouped: DataFrame, packed: Sequence[str], columns: Sequence[str],
                        processed_at: Column | None = None) -> DataFrame:
    """X2's remaining steps (null drop, strip) and the silver projection, after ``group_raw``."""
    first = unpack_first(grouped, ["content_id"], packed, columns)
    return _project_silver(strip_string_columns(first.na.drop(subset=CRITICAL_COLUMNS)), processed_at)


def build_silver(raw: DataFrame, processed_at: Column | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """Canonical silver from a raw event frame, without the validation gate.

    Hours that are no whole number are null here; a run quarantines such rows (rule ``labor_hours_type``), and those
    whose bytes were no UTF-8 (rule ``utf8_text``).
    """
    return _project_silver(clean(conform_content(normalize_columns(raw)), order), processed_at).drop(*RULE_COLUMNS)


def _project_silver(c: DataFrame, processed_at: Column | None) -> DataFrame:
    """The 12 silver columns, and those of the columns that only rules look at which the frame has."""
    given = {n: F.col(n) for n in ("content_id", "labor_hours", "event_type") if n in c.columns}
    all_of = {"event_type": F.lit(None).cast("string"), **given, **_derived(c.columns)}
    made = [all_of[n].alias(n) for n in SILVER_COLUMNS if n in all_of]
    return c.select(*made, *silver_metadata(processed_at), *[n for n in RULE_COLUMNS if n in c.columns])


def broken_rows(raw: DataFrame) -> DataFrame:
    """Rows marked ``bad_encoding`` in the silver columns. They are kept out of the de-duplication: replaced bytes may make keys equal."""
    return _project_silver(strip_string_columns(normalize_columns(raw).where(BAD_ENCODING)), None)


def bronze_table_rows(raw: DataFrame) -> DataFrame:
    """A run's bronze rows in the columns of bronze.content_events_raw."""
    time = parse_event_time("timestamp") if "timestamp" in raw.columns else F.lit(None).cast("timestamp")
    names = ["content_id", "title", "category", "region", "department", "labor_hours", "event_type"]
    own = [F.col(n) if n in raw.columns else F.lit(None).cast("string").alias(n) for n in names]
    return raw.select(*own, time.alias("event_timestamp"), "source_system", "ingested_at")


def transform(raw: DataFrame, processed_at: Column | None = None,
              required: Sequence[str] = REQUIRED_COLUMNS) -> tuple[DataFrame, dict]:
    """Validate (one aggregate job) -> raise on failure -> silver plan."""
    raw = conform_content(raw)
    passed, report = validate(raw, required)
    if not passed:
        raise ValidationError(failure_reason(report))
    return build_silver(raw, processed_at), report
